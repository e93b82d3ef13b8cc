"""Landing records as JSON lines, with the torn ones kept apart instead of lost.

Each line is to hold one record. Lines that do not are rejected with a reason, their text and their file:

* ``torn``: not one whole JSON value (cut off, two records glued together, anything else), or an object that names a field twice;
* ``no record``: JSON, but not one object;
* ``wrong type``: a field does not fit the schema;
* ``no key``: the key is missing or null.

Blank lines are neither kept nor rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

RESCUED = "_rescued"


def read_lines(spark: SparkSession, path: str, schema: StructType, key: str, glob: str = "*") -> DataFrame:
    """``record`` (the fields of ``schema``), ``line``, ``file`` and ``reason`` (NULL where the line is good) of every line in the
    files below ``path``. All fields are parsed whatever columns are used later, so that a line is always judged alike."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    lines = reader.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    lines = lines.where(F.trim("line") != "")
    wanted = StructType([*schema.fields]).add(RESCUED, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED}
    parsed = lines.withColumn("record", F.from_json("line", wanted, options))
    return parsed.select(
        F.col("record").dropFields(RESCUED).alias("record"), "line", "file", _reason(F.col(f"record.{key}")).alias("reason"))


def _reason(key: Column) -> Column:
    # Spark's parsers stop after the first value. What follows it may close one of two frames, but never both.
    framed = F.try_parse_json(F.concat(F.lit('{"line":'), F.col("line"), F.lit("}")))
    listed = F.try_parse_json(F.concat(F.lit("["), F.col("line"), F.lit("]")))
    one_object = F.schema_of_variant(framed).startswith("OBJECT<line: OBJECT<")
    return (
        F.when(framed.isNull() | listed.isNull(), "torn")
        .when(~one_object, "no record")
        .when(F.col(f"record.{RESCUED}").isNotNull(), "wrong type")
        .when(key.isNull(), "no key")
    )


def good_records(lines: DataFrame) -> DataFrame:
    return lines.where("reason IS NULL").select("record.*")


def rejects(lines: DataFrame) -> DataFrame:
    """``file, reason, line`` of what is not kept."""
    return lines.where("reason IS NOT NULL").select("file", "reason", "line")


def ingest_lines(lines: DataFrame, kept_path: str, rejects_path: str) -> DataFrame:
    """Writes both sides; one row with how many lines were kept, and rejected for each reason, counted in what was written."""
    good_records(lines).write.mode("overwrite").parquet(kept_path)
    rejects(lines).write.mode("overwrite").partitionBy("reason").parquet(rejects_path)
    spark = lines.sparkSession
    # without any reject there is no file to take a schema from
    refused = spark.read.schema("file string, line string, reason string").parquet(rejects_path).select("reason")
    written = spark.read.parquet(kept_path).select(F.lit(None).cast("string").alias("reason")).unionByName(refused)
    return written.agg(F.count_if(F.col("reason").isNull()).alias("n_kept"), *(
        F.count_if(F.col("reason") == reason).alias(f"n_{reason.replace(' ', '_')}")
        for reason in ("torn", "no record", "wrong type", "no key")))
