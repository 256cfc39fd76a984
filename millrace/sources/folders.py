"""Small file-system steps on any store that Spark reaches: existence, listing, markers, pointers."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none for a folder that does not exist."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder and those above it, unless it is there."""
    system, place = _place(spark, path)
    system.mkdirs(place)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder with all it holds; False if it was not there."""
    system, place = _place(spark, path)
    return system.delete(place, True)


def _plain(spark: SparkSession, path: str) -> tuple[Any, Any, bool]:
    """A file's system without checksum files, the place, and whether it is a local disk.

    Local disks keep a checksum beside each file, which no step could replace together with it.
    """
    system, place = _place(spark, path)
    local = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.LocalFileSystem").isInstance(system)
    return (system.getRawFileSystem() if local else system), place, local


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that a reader sees the old text or the new one, never a part.

    The text goes to a file of another name first, which then takes the place of the old one. The
    name starts with a dot, so that no reader takes it for data.
    """
    system, place, local = _plain(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if local:
        if not system.rename(draft, place):
            raise OSError(f"could not replace {path}")
        return
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(draft, place, options)


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if there is no such file."""
    system, place, _ = _plain(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
