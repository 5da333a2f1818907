"""Small files next to the data, through the Hadoop file system Spark already uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _fs(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, name: str) -> str:
    """The full address of a path; one without scheme belongs to Spark's default file system."""
    fs = _fs(spark, name)
    return fs.makeQualified(_path(spark, name)).toString()


def entries(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names in a folder and when each was last changed (seconds), empty if there is no folder."""
    fs = _fs(spark, folder)
    if not fs.exists(_path(spark, folder)):
        return {}
    found = fs.listStatus(_path(spark, folder))
    return {status.getPath().getName(): status.getModificationTime() / 1000 for status in found}


def names_in(spark: SparkSession, folder: str) -> list[str]:
    return list(entries(spark, folder))


def read_text(spark: SparkSession, name: str) -> str:
    stream = _fs(spark, name).open(_path(spark, name))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, name: str, text: str) -> bool:
    """Create a file in one step; False if the name is taken.

    The text goes to a temporary name first and is renamed, so a reader sees
    the whole file or none. Rename refuses a taken name on HDFS and on local
    disks; object stores without atomic rename give no such promise.
    """
    fs = _fs(spark, name)
    folder, _, last = name.rpartition("/")
    draft = f"{folder}/.{last}.{uuid.uuid4().hex}"
    stream = fs.create(_path(spark, draft), False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.exists(_path(spark, name)) and fs.rename(_path(spark, draft), _path(spark, name)):
        return True
    fs.delete(_path(spark, draft), False)
    return False


def remove(spark: SparkSession, name: str) -> None:
    _fs(spark, name).delete(_path(spark, name), True)
