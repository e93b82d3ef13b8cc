"""Checksum manifests and the verification of files against them."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from novalake.functions.text import base_name, blank_separated_fields
from novalake.sources.files import fs_path

# So many bytes of a file are held at once while it is hashed.
PIECE_BYTES = 1048576


def parse_manifest(lines: DataFrame, order: Column, text: str = "value") -> DataFrame:
    """``filename, md5`` per listed file.

    A line needs two fields: the hash comes first, the path last. When a file
    is listed more than once the last line in ``order`` counts.
    """
    parts = F.col("_parts")
    entries = (
        lines.select(blank_separated_fields(F.col(text)).alias("_parts"), order.alias("_order"))
        .where(F.size(parts) >= 2)
        .select(
            base_name(F.element_at(parts, -1)).alias("filename"),
            F.element_at(parts, 1).alias("md5"),
            "_order",
        )
    )
    return entries.groupBy("filename").agg(F.max_by("md5", "_order").alias("md5"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Reads one manifest file; line order is block offset, then order in the block."""
    lines = spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        ).alias("_line"),
    )
    return parse_manifest(lines, F.col("_line"))


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )


def hash_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, md5`` per file that :func:`read_files` would read.

    On a mounted file system a file is read piece by piece, however large it is, and its content never becomes a
    row. In other stores, which only Spark's readers open, files are read whole, up to 2 GiB.
    """
    files = read_files(spark, path, glob)
    if fs_path(spark, path)[0].getUri().getScheme() != "file":
        return files.select("path", F.md5("content").alias("md5"))

    def md5(uri: str) -> str:
        digest = hashlib.md5()
        with open(re.sub("^file:(//[^/]*)?", "", uri), "rb") as file:
            while piece := file.read(PIECE_BYTES):
                digest.update(piece)
        return digest.hexdigest()

    def run(batches):
        for batch in batches:
            uris = batch.column("path")
            yield pa.RecordBatch.from_arrays([uris, pa.array([md5(uri.as_py()) for uri in uris], pa.string())], ["path", "md5"])

    return files.select("path").mapInArrow(run, "path string, md5 string")


def verify_checksums(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``filename, md5, expected_md5, status`` per file (``path``, and ``content`` or its ``md5``).

    Hashes are taken in the scan, so only names and hashes are shuffled.
    """
    digest = F.col("md5") if "md5" in files.columns else F.md5("content")
    hashed = files.select(base_name(F.col("path")).alias("filename"), digest.alias("md5"))
    expected = manifest.select("filename", F.col("md5").alias("expected_md5"))
    status = (
        F.when(F.col("expected_md5").isNull(), "no expected hash")
        .when(F.col("md5") == F.col("expected_md5"), "match")
        .otherwise("mismatch")
    )
    return hashed.join(expected, "filename", "left").withColumn("status", status)
