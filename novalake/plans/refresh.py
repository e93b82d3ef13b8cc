"""Daily refresh and backfill of the lake: each table when those it needs are built, the others meanwhile."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from contextlib import ExitStack
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from novalake.operators.combine import match_keys
from novalake.operators.dedupe import dedupe_by_key
from novalake.operators.reshape import AUDIT
from novalake.plans import silver
from novalake.plans.flow import AT_ONCE, build_all
from novalake.session import tidy, utc
from novalake.sources.landing import batch_of, valid_records
from novalake.sources.ledger import Ledger, fingerprint
from novalake.sources.tables import (
    TableSpec,
    ensure_namespace,
    has_duplicates,
    held,
    layer_schema,
    read_table,
    scans_parquet,
    table_exists,
    upsert_table,
)

# Default batch and first night there is data for.
DEFAULT_DATE = "2024-02-01"
FIRST_DATE = "2018-06-01"

# Marks detections that are current rows; orders a batch, not stored.
CURRENT = "is_current"

BRONZE_ALERT = TableSpec("bronze", "alert", ("candid",), ("observation_date",), ("objectId", "candid"))

# Keys, partitions and sort order of the silver tables. The time of a row is part of
# the key, or follows from it: an alert id stands for one exposure, a reference image has one start.
# Not so for detection, where a history row may carry other values for the id, nor for bronze,
# where an alert may be sent again on another night.
SILVER = {
    spec.name: replace(spec, unstored=(*silver.BATCH, CURRENT))
    for spec in (
        TableSpec("silver", "crossmatch_gaia", ("objectid", "candid"),
                  ("ts_day",), ("objectid", "ts"), "ts", key_fixes_partition=True),
        TableSpec("silver", "crossmatch_ps1", ("objectid", "candid", "objectidps"),
                  ("ts_day",), ("objectid", "ts"), "ts", key_fixes_partition=True),
        TableSpec("silver", "crossmatch_ss", ("objectid", "candid"),
                  ("ts_day",), ("objectid", "ts"), "ts", key_fixes_partition=True),
        TableSpec("silver", "non_detection", ("objectid", "fid", "pid", "mjd"),
                  ("fid", "ts_day"), ("objectid", "ts"), "ts", key_fixes_partition=True, repeats=True),
        TableSpec("silver", "reference", ("objectid", "fid", "rfid"),
                  ("fid", "ts_day"), ("objectid", "startref_ts"), "startref_ts", key_fixes_partition=True),
        TableSpec("silver", "detection", ("objectid", "candid"),
                  ("fid", "ts_day"), ("objectid", "ts"), "ts", repeats=True),
        TableSpec("silver", "forced_photometry", ("objectid", "fid", "pid", "rfid", "mjd"),
                  ("fid", "ts_day"), ("objectid", "ts"), "ts", key_fixes_partition=True),
    )
}

# Tables that need nothing but the alerts; detection also needs reference.
ALERT_ONLY: dict[str, Callable[..., DataFrame]] = {
    "reference": silver.reference,
    "crossmatch_gaia": silver.crossmatch_gaia,
    "crossmatch_ps1": silver.crossmatch_ps1,
    "crossmatch_ss": silver.crossmatch_ss,
    "non_detection": silver.non_detection,
    "forced_photometry": silver.forced_photometry,
}

# What each table needs before it may be built.
NEEDS: dict[str, tuple[str, ...]] = (
    {"alert": ()} | {name: ("alert",) for name in ALERT_ONLY} | {"detection": ("alert", "reference")}
)


def prepare_layers(spark: SparkSession, root: str, bronze: str | None = None, other: str | None = None):
    """Namespaces of both layers; a custom name is used as given."""
    for layer, custom in (("bronze", bronze), ("silver", other)):
        ensure_namespace(spark, layer_schema(custom, layer), f"{root.rstrip('/')}/{layer}")


def upsert_detections(
    rows: DataFrame, root: str, per: Sequence[str], keep_richer: bool, stamp: dt.datetime | None = None
) -> None:
    """Upserts detections; by default a history row replaces whatever is stored.

    A history row lacks the columns only a current row has, so the upsert may
    overwrite a fuller row. With ``keep_richer`` a history row never replaces a
    stored row, nor a current row of its own batch.
    """
    spec = SILVER["detection"]
    if not keep_richer:
        upsert_table(rows, root, spec, latest=per, stamp=stamp)
        return
    spark, path = rows.sparkSession, spec.path(root)
    with ExitStack() as kept:
        if table_exists(spark, path):
            staged = kept.enter_context(held(rows, "detections"))
            stored = read_table(spark, path, rows.schema)
            if stamp:  # rows of a broken attempt at this batch are no stored rows
                stored = stored.where(~F.col(AUDIT).eqNullSafe(F.lit(stamp)))
            rows = staged.where(CURRENT).unionByName(
                match_keys(staged.where(~F.col(CURRENT)), stored, spec.keys, "left_anti")
            )
        upsert_table(rows, root, spec, latest=[CURRENT, *per], stamp=stamp)


Step = Callable[[dt.datetime | None], None]


def _silver_steps(
    alerts: Callable[[], DataFrame], root: str, per: Sequence[str], keep_richer: bool, kept: ExitStack
) -> dict[str, Step]:
    """How each silver table is written from one stored batch of alerts. The reference rows of a batch cover its
    alerts, so detection joins those, and not a table that grows with the years."""
    references: list[DataFrame] = []

    def reference_rows() -> DataFrame:
        if not references:
            references.append(kept.enter_context(held(silver.reference(alerts(), per), "references")))
        return references[0]

    def reference(stamp: dt.datetime | None) -> None:
        upsert_table(reference_rows(), root, SILVER["reference"], latest=per, staged=True, stamp=stamp)

    def detection(stamp: dt.datetime | None) -> None:
        rows = silver.detection(alerts(), reference_rows(), per, origin=CURRENT)
        upsert_detections(rows, root, per, keep_richer, stamp)

    def other(name: str, stamp: dt.datetime | None) -> None:
        upsert_table(ALERT_ONLY[name](alerts(), per), root, SILVER[name], latest=per, stamp=stamp)

    return {name: partial(other, name) for name in ALERT_ONLY} | {"reference": reference, "detection": detection}


def refresh_day(
    spark: SparkSession,
    landing: DataFrame,
    root: str,
    date: str = DEFAULT_DATE,
    keep_richer: bool = False,
    at_once: int = AT_ONCE,
) -> None:
    """Upserts one observation date into bronze and every silver table."""
    def bronze(stamp: dt.datetime | None) -> None:
        upsert_table(valid_records(batch_of(landing, date)), root, BRONZE_ALERT, stamp=stamp)

    def stored_alerts() -> DataFrame:
        return batch_of(read_table(spark, BRONZE_ALERT.path(root), landing.schema), date)

    with utc(spark), tidy(spark), ExitStack() as kept:
        steps = {"alert": bronze} | _silver_steps(stored_alerts, root, (), keep_richer, kept)
        build_all(spark, NEEDS, {name: partial(step, None) for name, step in steps.items()}, at_once)


def backfill(
    spark: SparkSession,
    landing: DataFrame,
    root: str,
    first: str = FIRST_DATE,
    last: str | None = None,
    keep_richer: bool = False,
    at_once: int = AT_ONCE,
) -> None:
    """A range of dates in one pass per table; same tables as the loop over days.

    Rows meet only rows of their own date, and per key the latest date wins. All tables read the alerts column by column:
    from the landing files where these are Parquet and no alert comes twice within a date, else from a copy that is staged
    once, without repeats, and goes with the run.

    A run that stops is taken up by the next call with the same dates and the same landing files: tables that its
    ledger has as done are left as they are, one that was being written is written again, as if for the first time.
    """
    per, keys = silver.BATCH, [*silver.BATCH, "candid"]
    with utc(spark), tidy(spark), ExitStack() as kept:
        batch = batch_of(landing, first, last or "9999-12-31")
        mark = fingerprint(batch, keys)
        ledger = Ledger(spark, root, f"{first}_{last or 'open'}_{mark}{'_richer' * keep_richer}")
        alerts = valid_records(batch)
        repeated = has_duplicates(alerts, keys)
        if repeated:
            alerts = dedupe_by_key(alerts, keys)
        if repeated or not scans_parquet(alerts):
            alerts = kept.enter_context(held(alerts, "backfill"))

        def bronze(stamp: dt.datetime | None) -> None:
            newest = alerts
            if has_duplicates(alerts, ["candid"]):  # the ids alone tell which row is the newest
                last_date = alerts.groupBy(F.col("candid").alias("_id")).agg(F.max(per[0]).alias("_date"))
                same = (F.col("candid") == F.col("_id")) & (F.col(per[0]) == F.col("_date"))
                newest = alerts.join(last_date, same, "left_semi")
            upsert_table(newest, root, BRONZE_ALERT, staged=True, stamp=stamp)

        def marked(name: str, step: Step) -> None:
            if not ledger.is_done(name):
                step(ledger.begin(name))
                ledger.finish(name)

        steps = {"alert": bronze} | _silver_steps(lambda: alerts, root, per, keep_richer, kept)
        build_all(spark, NEEDS, {name: partial(marked, name, step) for name, step in steps.items()}, at_once)
        ledger.close()
