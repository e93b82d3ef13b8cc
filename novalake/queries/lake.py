"""Lake tables: creation, evolution, layout, upserts, and the whole refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from novalake.fixtures import listed_alerts, table
from novalake.operators.combine import merge_upsert
from novalake.plans.refresh import BRONZE_ALERT, SILVER, backfill, refresh_day
from novalake.queries.inputs import A, FP, FP_LISTED, H, H_LISTED, r6
from novalake.queries.shown import comparable
from novalake.queries.silver_tables import ORACLE as SILVER_ORACLE
from novalake.queries.silver_tables import detection_sql
from novalake.session import new_stage_path, prepare
from novalake.sources.compaction import compact_table
from novalake.sources.landing import read_landing, write_landing
from novalake.sources.tables import (
    TARGET_FILE_BYTES,
    TableSpec,
    append_evolving,
    create_like,
    ensure_namespace,
    layer_schema,
    read_evolved,
    read_table,
    stage,
    table_exists,
    upsert_table,
    with_day,
    write_clustered,
)

ORDERS = TableSpec("silver", "orders", ("o_orderkey",), ("ts_day",), ("o_custkey", "o_orderdate"), "o_orderdate")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def create_empty_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table with the columns of the events, then all events in it."""
    events, path = _events(spark, sf_dir), new_stage_path(spark, "like")
    create_like(events, path, ["event_type"])
    empty = read_table(spark, path, events.schema)
    before = empty.agg(F.count("*").alias("n_before"))
    rows_before = before.first().n_before
    create_like(events, path, ["event_type"])  # exists: nothing happens
    append_evolving(events, path, ["event_type"])
    return read_table(spark, path).select(
        "event_id", "event_type", "value", F.lit(rows_before).cast("bigint").alias("n_before")
    )


def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = _events(spark, sf_dir), new_stage_path(spark, "evolve")
    append_evolving(events.where("event_id % 2 = 0").drop("props"), path)
    append_evolving(events.where("event_id % 2 = 1").drop("value"), path)
    return read_evolved(spark, path).select("event_id", "event_type", "value", "props")


def compact_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended thirty times, then compacted: each type's rows, and its files before and after."""
    events, path = _events(spark, sf_dir), new_stage_path(spark, "compact")
    for n in range(30):
        append_evolving(events.where(f"event_id % 30 = {n}"), path, ["event_type"])

    def files(name: str) -> DataFrame:
        kept = read_table(spark, path).select("event_type", "_metadata.file_path")
        return kept.groupBy("event_type").agg(F.count_distinct("file_path").alias(name))

    before = stage(files("files_before"), "files")
    compact_table(spark, path, TARGET_FILE_BYTES, ["event_id"])
    rows = read_table(spark, path).groupBy("event_type").agg(
        F.count("*").alias("n_events"), F.sum("event_id").alias("sum_id"), F.sum("user_id").alias("sum_user"),
        F.count("props").alias("n_props"))
    return rows.join(before, "event_type").join(files("files_after"), "event_type")


def layer_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in the schema its layer names, created on demand."""
    layer = layer_schema(" novalake_bronze ", "default")
    ensure_namespace(spark, layer, new_stage_path(spark, "warehouse"))
    path = new_stage_path(spark, "routed")
    _events(spark, sf_dir).write.mode("overwrite").option("path", path).saveAsTable(f"{layer}.events")
    return spark.table(f"{layer}.events").select("event_id", "user_id", "event_type")


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders; then a third of them changed, and as many new ones."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    changed = orders.where("o_orderkey % 3 = 0")
    source = changed.withColumn("o_orderstatus", F.lit("U")).unionByName(
        changed.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    )
    return orders, source


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _two_batches(spark, sf_dir)
    return merge_upsert(target, source, ["o_orderkey"])


def _null_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("o_custkey", F.expr("CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END"))


def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rerun of a batch: rows with a NULL key are added again."""
    target, source = _two_batches(spark, sf_dir)
    return merge_upsert(_null_keys(target), _null_keys(source), ["o_orderkey", "o_custkey"])


def merge_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _two_batches(spark, sf_dir)
    return merge_upsert(
        _null_keys(target), _null_keys(source), ["o_orderkey", "o_custkey"], null_safe=True
    )


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "ts_day"]


def _monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_trunc("MONTH", F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", month)


def first_run_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_stage_path(spark, "lake")
    orders = _monthly_orders(spark, sf_dir)
    created = not table_exists(spark, ORDERS.path(root))
    upsert_table(orders, root, ORDERS)
    return read_table(spark, ORDERS.path(root)).select(
        *_ORDER_COLUMNS, F.lit(created).alias("created"),
        F.col("_created_ts").isNotNull().alias("stamped"),
    )


def upsert_moves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch changes some orders and moves them ten days, to other partitions."""
    root = new_stage_path(spark, "lake")
    orders = _monthly_orders(spark, sf_dir)
    moved = (
        orders.where("o_orderkey % 3 = 0")
        .withColumn("o_orderstatus", F.lit("U"))
        .withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 10 DAYS"))
    )
    upsert_table(orders, root, ORDERS)
    upsert_table(moved.unionByName(moved), root, ORDERS)  # every key twice
    return read_table(spark, ORDERS.path(root)).select(*_ORDER_COLUMNS)


def partition_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_stage_path(spark, "days")
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    write_clustered(with_day(events, "ts"), path, ["event_type", "ts_day"], ["user_id", "ts"])
    return read_table(spark, path).groupBy("event_type", "ts_day").agg(
        F.count("*").alias("n_events"), F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


def clustered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range-distributed, sorted files; read back whole."""
    path = new_stage_path(spark, "clustered")
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    write_clustered(with_day(events, "ts"), path, ["ts_day"], ["user_id", "ts"])
    return read_table(spark, path).select("event_id", "user_id", "event_type", "ts_day")


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, alerts = new_stage_path(spark, "landing"), listed_alerts(spark, sf_dir, dealt=True)
    write_landing(alerts, path, dealt=True)
    return read_landing(spark, path, "parquet", alerts.schema)


_lakes: dict[tuple[str, str], str] = {}


def _filled_lake(spark: SparkSession, sf_dir: str) -> str:
    """Landing files to bronze and all silver tables; once for a session and its data, as long as nobody deletes them."""
    built = (spark.sparkContext.applicationId, sf_dir)
    tables = (BRONZE_ALERT, *SILVER.values())
    if built not in _lakes or not all(table_exists(spark, spec.path(_lakes[built])) for spec in tables):
        root = new_stage_path(spark, "lake")
        backfill(spark, _landed(spark, sf_dir), root, "2024-01-01", "2024-01-30")
        _lakes[built] = root
    prepare(spark)
    return _lakes[built]


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    return comparable(read_table(spark, SILVER[name].path(root)).drop("_created_ts", "ts_day"))


def lake_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detections of a backfilled lake."""
    return _stored(spark, _filled_lake(spark, sf_dir), "detection")


def lake_bronze_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, BRONZE_ALERT.path(_filled_lake(spark, sf_dir)))
    return comparable(rows.select(
        F.col("objectId").alias("objectid"), "candid", "candidate.magpsf", "observation_date",
        F.size("prv_candidates").alias("n_history"), F.size("fp_hists").alias("n_forced")))


def _lake_table(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _stored(spark, _filled_lake(spark, sf_dir), name)
    return query


def lake_refresh_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nights, one refresh each: the second replaces what it knows of the first."""
    landing, root = _landed(spark, sf_dir), new_stage_path(spark, "lake")
    for date in ("2024-01-01", "2024-01-02"):
        refresh_day(spark, landing, root, date)
    prepare(spark)
    return _stored(spark, root, "detection")


QUERIES = {
    "create_empty_like": create_empty_like,
    "append_evolve": append_evolve,
    "compact_appends": compact_appends,
    "layer_routing": layer_routing,
    "merge_upsert": merged,
    "merge_null_keys": merge_null_keys,
    "merge_null_safe": merge_null_safe,
    "first_run_create": first_run_create,
    "upsert_moves_rows": upsert_moves_rows,
    "partition_days": partition_days,
    "clustered_write": clustered_write,
    "lake_backfill": lake_backfill,
    "lake_refresh_two_days": lake_refresh_two_days,
    "lake_bronze_alert": lake_bronze_alert,
} | {f"lake_{name}": _lake_table(name) for name in SILVER if name != "detection"}

_batches = """t AS (SELECT o_orderkey, {c} AS o_custkey, o_orderstatus, o_totalprice FROM orders),
s AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice FROM t WHERE o_orderkey % 3 = 0
  UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice FROM t WHERE o_orderkey % 3 = 0)"""
_nulls = "CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END"


def _merge_sql(custkey: str, match: str) -> str:
    return f"""WITH {_batches.replace('{c}', custkey)}
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {match}) UNION ALL SELECT * FROM s"""


def _latest_detections(last: str) -> str:
    """Detections of the nights up to ``last``; of an id, those of its latest night."""
    return f"""SELECT * EXCLUDE (observation_date) FROM (
SELECT * FROM ({detection_sql(H_LISTED)}) WHERE observation_date <= DATE '{last}' QUALIFY row_number() OVER
  (PARTITION BY objectid, candid ORDER BY observation_date DESC) = 1)"""


ORACLE = {
    "create_empty_like": "SELECT event_id, event_type, value, CAST(0 AS BIGINT) AS n_before FROM events",
    "append_evolve": """SELECT event_id, event_type, value, CAST(NULL AS VARCHAR) AS props FROM events
WHERE event_id % 2 = 0 UNION ALL BY NAME
SELECT event_id, event_type, props FROM events WHERE event_id % 2 = 1""",
    "compact_appends": """SELECT event_type, count(*) AS n_events, CAST(sum(event_id) AS BIGINT) AS sum_id,
  CAST(sum(user_id) AS BIGINT) AS sum_user, count(props) AS n_props,
  count(DISTINCT event_id % 30) AS files_before, CAST(1 AS BIGINT) AS files_after FROM events GROUP BY event_type""",
    "layer_routing": "SELECT event_id, user_id, event_type FROM events",
    "merge_upsert": _merge_sql("o_custkey", "s.o_orderkey = t.o_orderkey"),
    "merge_null_keys": _merge_sql(_nulls, "s.o_orderkey = t.o_orderkey AND s.o_custkey = t.o_custkey"),
    "merge_null_safe": _merge_sql(
        _nulls, "s.o_orderkey = t.o_orderkey AND s.o_custkey IS NOT DISTINCT FROM t.o_custkey"
    ),
    "first_run_create": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS ts_day, true AS created, true AS stamped FROM orders""",
    "upsert_moves_rows": """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
  CAST(date_trunc('month', o_orderdate) AS DATE)
    + CAST(CASE WHEN o_orderkey % 3 = 0 THEN 10 ELSE 0 END AS INTEGER) AS ts_day FROM orders""",
    "partition_days": """SELECT event_type, CAST(ts AS DATE) AS ts_day, count(*) AS n_events,
  min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY ALL""",
    "clustered_write": "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS ts_day FROM events",
    "lake_backfill": _latest_detections("2024-01-30"),
    "lake_refresh_two_days": _latest_detections("2024-01-02"),
    "lake_bronze_alert": f"""WITH {A} SELECT objectid, candid, {r6('magpsf')} AS magpsf, observation_date,
  CAST(4 AS INTEGER) AS n_history, CAST(1 AS INTEGER) AS n_forced FROM a""",
    "lake_reference": f"SELECT * EXCLUDE (observation_date) FROM ({SILVER_ORACLE['batch_backfill']})",
    "lake_non_detection": "SELECT DISTINCT * EXCLUDE (observation_date) FROM ("
                          + SILVER_ORACLE["non_detection"].replace(H, H_LISTED) + ")",
    "lake_forced_photometry": "SELECT * EXCLUDE (observation_date) FROM ("
                              + SILVER_ORACLE["forced_photometry"].replace(FP, FP_LISTED) + ")",
} | {f"lake_{name}": f"SELECT * EXCLUDE (observation_date) FROM ({SILVER_ORACLE[name]})"
     for name in ("crossmatch_gaia", "crossmatch_ps1", "crossmatch_ss")}

