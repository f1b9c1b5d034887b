"""Getting files and code to all machines of a session."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import SparkSession

_shipped: set[tuple] = set()


def new_shared_directory(spark: SparkSession, name: str) -> str:
    """A fresh folder (not created yet) in the one that every machine of the cluster sees."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can write to")
        shared = tempfile.mkdtemp(prefix="osm-fixtures-")
    if shared.startswith("file:/") and not shared.startswith("file://"):
        shared = "file://" + shared[len("file:") :]  # as Arrow spells it
    directory = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, directory)
    return directory


def _remove(directory: str) -> None:
    system, root = fs.FileSystem.from_uri(directory)
    if system.get_file_info(root).type == fs.FileType.Directory:
        system.delete_dir(root)


def ship_packages(spark: SparkSession, directory: str, *packages: str) -> None:
    """Let the workers import the packages in ``directory``, as ``--py-files`` would; once per session."""
    key = (spark.sparkContext.applicationId, directory, packages)
    if key in _shipped:
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for package in packages:
            for file in sorted(Path(directory, package).rglob("*.py")):
                out.write(file, file.relative_to(directory))
    target = new_shared_directory(spark, "code")
    system, root = fs.FileSystem.from_uri(target)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/packages.zip") as stream:
        stream.write(archive.getvalue())
    spark.sparkContext.addPyFile(f"{target}/packages.zip")
    _shipped.add(key)
