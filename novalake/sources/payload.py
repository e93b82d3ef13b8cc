"""Image payloads, split off the alert records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from novalake.functions.text import payload_key
from novalake.operators.reshape import drop_prefixed


def payload_columns(df: DataFrame, prefix: str = "cutout") -> list[tuple[str, str]]:
    """(column, bytes field) of each payload column, whatever the case of the field."""
    found = []
    for field in df.schema.fields:
        if field.name.startswith(prefix) and isinstance(field.dataType, StructType):
            found += [
                (field.name, inner) for inner in field.dataType.names
                if inner.lower() == "stampdata"
            ]
    return found


def payload_rows(df: DataFrame, prefix: str = "cutout", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per image: ``candid``, ``cutout_type``, ``stamp_data``."""
    stamps = F.array(*(
        F.struct(
            F.lit(name).alias("cutout_type"), F.col(f"{name}.{inner}").alias("stamp_data")
        )
        for name, inner in payload_columns(df, prefix)
    ))
    return (
        df.where(F.col("candid").isNotNull())
        .select(*keep, "candid", F.inline(stamps))
        .where(F.col("stamp_data").isNotNull())
    )


def split_payload(df: DataFrame, prefix: str = "cutout") -> tuple[DataFrame, DataFrame]:
    """Alert records without images, and the images; two projections of one scan."""
    return drop_prefixed(df.where(F.col("candid").isNotNull()), prefix), payload_rows(df, prefix)


def with_payload_key(payloads: DataFrame, folder: str = "cutouts/") -> DataFrame:
    return payloads.withColumn(
        "object_key", payload_key(folder, F.col("candid").cast("string"), F.col("cutout_type"))
    )


def write_payloads(df: DataFrame, path: str, folder: str = "cutouts/", prefix: str = "cutout") -> None:
    """Images as table rows with their object key; replaces the dates in ``df``.

    One file per image would mean millions of tiny objects; a query that does
    not name ``stamp_data`` never reads the bytes. Images stay in the task that
    read them: no shuffle.
    """
    rows = with_payload_key(payload_rows(df, prefix, keep=("observation_date",)), folder)
    (
        rows.write.mode("overwrite").partitionBy("observation_date")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", str(32 * 1024 * 1024))
        .parquet(path)
    )
