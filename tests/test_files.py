import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from osm_tables.sources import files
from osm_tables.sources.files import ReadAhead, file_sizes, s3_settings, to_location

CONTENT = os.urandom(5000)


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    path = tmp_path_factory.mktemp("files") / "bytes"
    path.write_bytes(CONTENT)
    return str(path)


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 800)), max_size=20),
    st.integers(1, 1000),
    st.sampled_from([0, 100, 2500, 5000, 9999]),
)
def test_any_reads(path, reads, chunk, until):
    with ReadAhead(path, len(CONTENT), chunk, until) as source:
        for offset, length in reads:
            if offset + length <= len(CONTENT):
                assert source.read(offset, length) == CONTENT[offset : offset + length]
            else:
                with pytest.raises(EOFError):
                    source.read(offset, length)


@given(st.integers(0, 4900), st.integers(1, 3000), st.integers(0, 4999), st.integers(0, 800))
@settings(max_examples=100, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_buffered_reads(path, start, length, offset, n):
    with ReadAhead(path, len(CONTENT), 64) as source:
        held = source.buffered(start, start + length)
        if offset + n <= len(CONTENT):
            assert held.read(offset, n) == CONTENT[offset : offset + n]
        else:
            with pytest.raises(EOFError):
                held.read(offset, n)
        at = CONTENT[: start + length].find(CONTENT[offset : offset + 3], max(start, offset - 50))
        assert held.find(CONTENT[offset : offset + 3], max(start, offset - 50)) == at


@pytest.mark.parametrize("step", [1, 99, 100, 101, 700])
def test_reads_in_order(path, step):
    with ReadAhead(path, len(CONTENT), 100, len(CONTENT)) as source:
        for offset in range(0, len(CONTENT), step):
            length = min(step, len(CONTENT) - offset)
            assert source.read(offset, length) == CONTENT[offset : offset + length]


def test_file_that_shrank(path):
    with ReadAhead(path, len(CONTENT) + 100, 64) as source:
        with pytest.raises(EOFError, match="short read"):
            source.read(4990, 100)


@pytest.mark.parametrize(
    ("path", "default_fs", "location"),
    [
        ("/a b/x.pbf", None, "/a b/x.pbf"),
        ("file:///a b/x.pbf", None, "file:///a%20b/x.pbf"),
        ("file:///a%20b/x.pbf", None, "file:///a%20b/x.pbf"),
        ("file:/a/x.pbf", None, "file:///a/x.pbf"),
        ("s3a://bucket/x.pbf", None, "s3://bucket/x.pbf"),
        ("/a b/x.pbf", "hdfs://host:8020/", "hdfs://host:8020/a%20b/x.pbf"),
        ("/a/x.pbf", "file:///", "/a/x.pbf"),
        ("hdfs://other/x.pbf", "hdfs://host:8020", "hdfs://other/x.pbf"),
    ],
)
def test_locations(path, default_fs, location):
    assert to_location(path, default_fs) == location


def test_relative_paths(monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)
    assert to_location("x.pbf") == str(tmp_path / "x.pbf")


def test_sizes(path):
    assert file_sizes([path, f"file://{path}", path]) == [5000, 5000, 5000]


def test_s3_settings_reach_the_file_system(monkeypatch):
    given = s3_settings({"fs.s3a.access.key": "me", "FS.S3A.Endpoint": "http://store:9000", "fs.s3a.secret.key": None, "other": "x"})
    assert given == {"access_key": "me", "endpoint_override": "http://store:9000"}
    monkeypatch.setattr(files.fs, "S3FileSystem", lambda **settings: settings)
    assert files.file_system("s3://bucket/a%20b/x.pbf", given) == (given, "bucket/a b/x.pbf")
