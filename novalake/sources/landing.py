"""Landing files: nightly alert records under ``observation_date=`` folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_landing(
    spark: SparkSession,
    path: str,
    fmt: str = "avro",
    schema: StructType | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Hive-partitioned landing folder; the date filter prunes whole folders.

    The format is a parameter: Avro needs Spark's Avro module on the class
    path. With a schema given nothing is inferred; ``tolerant`` skips files
    that cannot be read (see :func:`skipped_files`).
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    return reader.load(path)


def read_archive(
    spark: SparkSession,
    path: str,
    fmt: str = "avro",
    schema: StructType | None = None,
    glob: str = "*.avro",
) -> DataFrame:
    """Every matching file below ``path``, however deep; folders carry no meaning."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("pathGlobFilter", glob).load(path)


def landing_view(df: DataFrame, name: str = "alerts") -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def batch_of(alerts: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """The rows of one observation date, or of a range of dates."""
    date = F.col("observation_date")
    if last is None:
        return alerts.where(date == F.to_date(F.lit(first)))
    return alerts.where(date.between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def skipped_files(df: DataFrame, spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files that were listed but gave no row (unreadable, or empty)."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(_plain_path(F.col("path")).alias("path"))
    )
    read = df.select(_plain_path(F.col("_metadata.file_path")).alias("path")).distinct()
    return listed.join(read, "path", "left_anti")


def _plain_path(uri):
    """Scheme-less path, so that ``file:/a`` and ``file:///a`` agree."""
    return F.regexp_replace(uri, r"^[a-zA-Z0-9]+:(//[^/]*)?", "")


def valid_records(df: DataFrame) -> DataFrame:
    """Records without an alert id cannot be keyed and are dropped."""
    return df.where(F.col("candid").isNotNull())


def count_columns(df: DataFrame, payload_prefix: str = "cutout") -> list[Column]:
    """How many records, how many dropped, how many lack payloads."""
    payloads = [c for c in df.columns if c.startswith(payload_prefix)]
    without = F.lit(True)
    for name in payloads:
        without = without & F.col(f"{name}.stampData").isNull()
    keyed = F.col("candid").isNotNull()
    return [
        F.count("*").alias("n_records"),
        F.count_if(~keyed).alias("n_without_candid"),
        F.count_if(keyed).alias("n_kept"),
        F.count_if(keyed & without).alias("n_without_payload"),
    ]


def record_counts(df: DataFrame, payload_prefix: str = "cutout") -> DataFrame:
    """The counts as one row."""
    return df.agg(*count_columns(df, payload_prefix))


# Of Spark's estimate of the records so many bytes go to a task.
DEALT_BYTES = 16777216


def dealt_by_date(rows: DataFrame, size: int, *then: str) -> DataFrame:
    """Rows dealt to tasks by date, and within a date by ``then``, sorted by date: what :func:`write_landing` needs, done before
    narrow rows become records of ``size`` bytes. A hot date is split over tasks and small dates are not."""
    columns = ["observation_date", *then]
    return rows.repartitionByRange(-(-size // DEALT_BYTES) or 1, *columns).sortWithinPartitions(*columns)


def write_landing(
    df: DataFrame, path: str, files: int | None = None, fmt: str = "parquet", dealt: bool = False
) -> None:
    """Writes the landing folders of the dates in ``df``, replacing those dates.

    ``files`` deals the records round-robin onto that many files per date, as
    for one night. Without it, adaptive execution sizes the files: a hot date
    is split over tasks and small dates are not, which suits a backfill.
    ``dealt`` says that the rows come from :func:`dealt_by_date`: whole records are not shuffled again.
    """
    spread = df if dealt else df.repartition(files) if files else df.hint("rebalance", "observation_date")
    (
        spread.write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("observation_date")
        .save(path)
    )


def run_summary(df: DataFrame, source: str, destination: str, skipped: bool = False) -> DataFrame:
    """One row on an ingest run: files and records taken, from where to where.

    ``df`` is the scan of the source. Its files are counted from the listing the
    scan already holds, so files without records count too.
    """
    return summarised(df.agg(F.count("*").alias("n_records")), df, source, destination, skipped)


def summarised(
    counts: DataFrame, scan: DataFrame, source: str, destination: str, skipped: bool = False
) -> DataFrame:
    """The summary from counts taken already."""
    n_files = len(scan._jdf.inputFiles())
    return counts.select(
        F.lit(n_files).cast("bigint").alias("n_files"), "*",
        F.lit(source).alias("source"), F.lit(destination).alias("destination"),
        F.lit(skipped).alias("skipped"),
    )
