"""Landing ingest and the bronze alert table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from novalake.functions.julian import jd_to_timestamp
from novalake.operators.reshape import with_audit
from novalake.sources.landing import (
    batch_of,
    count_columns,
    read_archive,
    summarised,
    write_landing,
)
from novalake.sources.payload import split_payload, write_payloads
from novalake.sources.tables import append_evolving, create_like


def ingest_landing(
    records: DataFrame,
    alert_path: str,
    payload_path: str,
    files: int | None = None,
    folder: str = "cutouts/",
    landing_format: str = "parquet",
) -> DataFrame:
    """Raw records to landing files plus a payload table; returns the counts.

    The alert write reads no image bytes and the payload write no alert body. The counts are taken
    along the payload write, which sees every record: no pass of their own.
    """
    alerts, _ = split_payload(records)
    write_landing(alerts, alert_path, files, landing_format)
    seen = Observation()
    write_payloads(records.observe(seen, *count_columns(records)), payload_path, folder)
    counts = [F.lit(n).cast("bigint").alias(name) for name, n in seen.get.items()]
    return records.sparkSession.range(1).select(*counts)


def ingest_night(
    spark: SparkSession,
    archive_path: str,
    date: str,
    alert_path: str,
    payload_path: str,
    fmt: str = "avro",
    glob: str = "*.avro",
    schema: StructType | None = None,
    files: int | None = None,
    landing_format: str = "parquet",
) -> DataFrame:
    """One night's extracted archive into the landing folder of its date.

    Records get the date of the night, not of their content. Returns one row: files and records
    taken, records without id or images, source, destination.
    """
    records = read_archive(spark, archive_path, fmt, schema, glob)
    dated = records.withColumn("observation_date", F.to_date(F.lit(date)))
    counts = ingest_landing(dated, alert_path, payload_path, files, landing_format=landing_format)
    return summarised(counts, records, archive_path, f"{alert_path}/observation_date={date}")


def bronze_alert(landing: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """The landing rows of a date (or range), stamped; upserted by the caller."""
    return with_audit(batch_of(landing, first, last))


def with_observation_time(records: DataFrame) -> DataFrame:
    return records.withColumn("observation_timestamp", jd_to_timestamp(F.col("candidate.jd")))


def append_bronze(records: DataFrame, path: str) -> None:
    """Append-only variant: create the table if missing, then add the rows.

    Partitioned by the day of ``observation_timestamp``; columns new to the
    table are added, and nothing is deduplicated.
    """
    day = "observation_day"
    rows = with_observation_time(records).withColumn(day, F.to_date("observation_timestamp"))
    create_like(rows, path, [day])
    append_evolving(rows, path, [day])


def bronze_job(spark: SparkSession, input_path: str, input_format: str, table_path: str) -> None:
    append_bronze(spark.read.format(input_format).load(input_path), table_path)
