"""Files and folders of the shared storage, whatever file system holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def fs_path(spark: SparkSession, path: str):
    """A path's file system, and the path for it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def fs_uri(spark: SparkSession, uri: str):
    """The same for an address in which special characters are escaped, as Spark's file metadata has it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written under another name, then renamed."""
    fs, draft = fs_path(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(draft, fs_path(spark, path)[1])


def read_note(spark: SparkSession, path: str) -> str:
    fs, file = fs_path(spark, path)
    stream = fs.open(file)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
