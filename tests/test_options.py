import pytest

from osm_tables import OsmReadOptions
from osm_tables.options import ENTITY_TYPES


def test_defaults():
    options = OsmReadOptions.parse({})
    assert options == OsmReadOptions()
    assert options.partitions == 1
    assert options.selected_types == frozenset(ENTITY_TYPES)
    assert not (options.exclude_metadata or options.exclude_tags or options.tags_as_map)
    assert not (options.way_nodes_as_id_list or options.include_origin_file)


@pytest.mark.parametrize(("text", "value"), [("0", 1), ("-3", 1), ("7", 7)])
def test_partitions_are_at_least_one(text, value):
    assert OsmReadOptions.parse({"PARTITIONS": text}).partitions == value


def test_bad_number():
    with pytest.raises(ValueError):
        OsmReadOptions.parse({"partitions": "x"})


@pytest.mark.parametrize(
    ("text", "types"),
    [
        ("Node, way", {"Node", "Way"}),
        ("RELATION", {"Relation"}),
        ("node\tway\nrelation", {"Node", "Way", "Relation"}),
        (",way", {"Way"}),
    ],
)
def test_types(text, types):
    assert OsmReadOptions.parse({"types": text}).types == types


@pytest.mark.parametrize("text", ["", " , "])
def test_no_types_means_all(text):
    assert OsmReadOptions.parse({"types": text}).types is None


def test_unknown_type_lists_valid_names():
    with pytest.raises(ValueError, match="'area'.*Node, Way, Relation"):
        OsmReadOptions.parse({"types": "area"})
    with pytest.raises(ValueError):
        OsmReadOptions().with_type("area")


def test_flags_are_true_only_for_true():
    assert OsmReadOptions.parse({"exclude-tags": "TRUE"}).exclude_tags
    assert not OsmReadOptions.parse({"exclude-tags": "yes"}).exclude_tags


def test_unknown_keys_are_ignored():
    assert OsmReadOptions.parse({"unknown": "1"}) == OsmReadOptions()


def test_paths():
    assert OsmReadOptions.parse({"paths": '["a","b"]', "path": "c"}).paths == ("a", "b", "c")
    assert OsmReadOptions.parse({"path": "a,b"}).paths == ("a,b",)
    with pytest.raises(ValueError):
        OsmReadOptions.parse({"paths": "a,b"})


def test_round_trip():
    options = (
        OsmReadOptions()
        .with_paths("a b", "c,d")
        .with_partitions(3)
        .with_type("way")
        .with_type("Node")
        .with_exclude_metadata()
        .with_exclude_tags()
        .with_tags_as_map()
        .with_way_nodes_as_id_list()
        .with_include_origin_file()
    )
    assert OsmReadOptions.parse(options.to_options()) == options
    assert options.to_options()["types"] == "Node,Way"


def test_to_options_leaves_out_what_is_off():
    assert OsmReadOptions().to_options() == {"partitions": "1"}


def test_options_are_immutable():
    options = OsmReadOptions()
    options.with_type("way")
    assert options.types is None
