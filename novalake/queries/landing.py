"""Landing files, manifests and payloads, written and read back whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from novalake.fixtures import candidate_alerts, landing_records, table
from novalake.operators.reshape import drop_prefixed, stack_branches
from novalake.plans.bronze import append_bronze, bronze_alert, ingest_landing, ingest_night
from novalake.queries.inputs import A, DAY, seconds
from novalake.queries.shown import comparable
from novalake.schemas import ALERT
from novalake.session import new_stage_path
from novalake.sources.landing import (
    batch_of,
    landing_view,
    read_archive,
    read_landing,
    record_counts,
    run_summary,
    skipped_files,
    valid_records,
    write_landing,
)
from novalake.sources.lines import ingest_lines, read_lines
from novalake.sources.manifest import hash_files, parse_manifest, read_manifest, verify_checksums
from novalake.sources.payload import payload_rows, split_payload, with_payload_key, write_payloads
from novalake.sources.tables import read_evolved

FIRST, LAST = "2024-01-01", "2024-01-30"  # the dates the derived alerts span


def _landed(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    path = new_stage_path(spark, "landing")
    write_landing(candidate_alerts(spark, sf_dir), path, files)
    return path


def landing_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = read_landing(spark, _landed(spark, sf_dir), "parquet", ALERT)
    rows = batch_of(landing_view(landing), FIRST, LAST)
    return comparable(rows.select(
        F.col("objectId").alias("objectid"), "candid", "candidate.magpsf", "observation_date"
    ))


def landing_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most ten files per date, as dealt out by ten writers."""
    landing = read_landing(spark, _landed(spark, sf_dir, files=10), "parquet", ALERT)
    per_date = landing.groupBy("observation_date").agg(
        F.count("*").alias("n_alerts"), F.sum("candid").alias("sum_candid"),
        (F.count_distinct(F.col("_metadata.file_name")) <= 10).alias("few_files"),
    )
    return per_date


def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir)
    files = read_archive(spark, path, "parquet", ALERT, glob="*.parquet")
    return comparable(files.select(
        F.col("objectId").alias("objectid"), "candid", "candidate.jd"
    ))


def tolerant_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts among the landing files cannot be read as Parquet and are skipped."""
    path = _landed(spark, sf_dir)
    table(spark, sf_dir, "documents").select("text").write.mode("append").text(
        f"{path}/observation_date=2024-01-31"
    )
    landing = read_landing(spark, path, "parquet", ALERT, tolerant=True)
    skipped = skipped_files(landing, spark, path, "part-*")
    return stack_branches([
        landing.select(F.lit("read").alias("kind"), "observation_date", "candid"),
        skipped.select(F.lit("skipped"), F.regexp_extract("path", "date=([^/]+)", 1).cast("date"),
                       F.lit(None).cast("bigint")).distinct(),
    ])


def torn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, many of them damaged: what is kept, and what is rejected and why."""
    folder, kept, refused = (new_stage_path(spark, name) for name in ("lines", "kept", "rejects"))
    line = F.concat(
        F.when(F.col("event_id") % 7 != 1, F.concat(F.lit('{"event_id":'), "event_id", F.lit(","))).otherwise(F.lit("{")),
        F.lit('"user_id":'), F.when(F.col("event_id") % 7 == 2, F.lit('"none"')).otherwise(F.col("user_id").cast("string")),
        F.lit(',"event_type":"'), "event_type", F.lit('"}'))
    damaged = (
        F.when(F.col("event_id") % 7 == 0, F.substr(line, F.lit(1), F.length(line) - F.lit(3)))
        .when(F.col("event_id") % 7 == 3, F.concat(line, line))
        .when(F.col("event_id") % 7 == 4, F.concat(F.lit("["), line, F.lit("]")))
        .otherwise(line))
    table(spark, sf_dir, "events").select(damaged.alias("value")).where("value IS NOT NULL").write.text(folder)
    schema = StructType.fromDDL("event_id bigint, user_id bigint, event_type string")
    counts = ingest_lines(read_lines(spark, folder, schema, "event_id", "part-*"), kept, refused).first().asDict()
    rows = stack_branches([
        spark.read.parquet(kept).select(F.lit("kept").alias("kind"), "event_id", "user_id", F.lit(None).cast("string").alias("line")),
        spark.read.parquet(refused).select("reason", F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), "line"),
    ])
    return rows.select("*", *(F.lit(n).cast("bigint").alias(name) for name, n in counts.items()))


def drop_prefixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_prefixed(landing_records(spark, sf_dir))
    return comparable(kept.select(
        F.col("objectId").alias("objectid"), "candid", "candidate.jd", "observation_date",
        F.lit(" ".join(kept.columns)).alias("columns_left"),
    ))


def valid_record_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_counts(landing_records(spark, sf_dir))


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_records(landing_records(spark, sf_dir))
    return rows.select(F.col("objectId").alias("objectid"), "candid", "observation_date")


def split_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, payloads = split_payload(landing_records(spark, sf_dir))
    return payloads.select(
        "candid", "cutout_type", F.md5("stamp_data").alias("md5"),
        F.octet_length("stamp_data").cast("bigint").alias("n_bytes"),
    )


def payload_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = payload_rows(landing_records(spark, sf_dir))
    return with_payload_key(rows, "cutouts").select("candid", "cutout_type", "object_key")


def payload_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_stage_path(spark, "payload")
    write_payloads(landing_records(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        "object_key", "observation_date", F.md5("stamp_data").alias("md5")
    )


def landing_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    alert_path, payload_path = new_stage_path(spark, "landing"), new_stage_path(spark, "payload")
    ingest_landing(landing_records(spark, sf_dir), alert_path, payload_path)
    counted = read_landing(spark, alert_path, "parquet").groupBy("observation_date").agg(
        F.count("*").alias("n_alerts"), F.sum(F.size("prv_candidates")).alias("n_history")
    )
    images = spark.read.parquet(payload_path).groupBy("observation_date").agg(
        F.count("*").alias("n_payloads"), F.sum(F.octet_length("stamp_data")).alias("n_bytes")
    )
    return counted.join(images, "observation_date", "left")


def _manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of the documents: some hashes wrong, some lines torn, some twice."""
    d = F.col("doc_id")
    name = F.concat(F.lit("archive/day "), F.lit("x/doc_"), d.cast("string"), F.lit(".txt"))
    good = F.md5(F.encode("text", "UTF-8"))
    line = (
        F.when(d % 11 == 0, F.concat(F.lit("  "), good))
        .when(d % 7 == 0, F.concat(F.md5(F.encode(F.lit("other"), "UTF-8")), F.lit(" \t"), name))
        .otherwise(F.concat(F.lit(" "), good, F.lit("  "), name, F.lit(" ")))
    )
    docs = table(spark, sf_dir, "documents")
    late = F.concat(good, F.lit("  late/doc_"), d.cast("string"), F.lit(".txt"))
    lines = F.array(
        F.struct(line.alias("value"), (d * 2).alias("line_no")),
        F.struct(F.when(d % 14 == 0, late).alias("value"), (d * 2 + 1).alias("line_no")),
    )
    return docs.select(F.inline(lines)).where(F.col("value").isNotNull())


def manifest_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_manifest(_manifest_lines(spark, sf_dir), F.col("line_no"))


def checksum_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("file:/archive/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )
    manifest = parse_manifest(_manifest_lines(spark, sf_dir), F.col("line_no"))
    return verify_checksums(files, manifest)


def bronze_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = read_landing(spark, _landed(spark, sf_dir), "parquet", ALERT)
    rows = bronze_alert(landing, FIRST, LAST)
    return comparable(rows.select(
        F.col("objectId").alias("objectid"), "candid", "candidate.fid", "candidate.magnr",
        "observation_date", F.col("_created_ts").isNotNull().alias("stamped"),
    ))


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends; the second brings a column the first lacked."""
    path = new_stage_path(spark, "bronze")
    every = candidate_alerts(spark, sf_dir).select("objectId", "candid", "candidate")
    append_bronze(every.where(F.col("candid") % 3 != 0), path)
    append_bronze(
        every.where(F.col("candid") % 3 == 0).withColumn("publisher", F.lit("second")), path
    )
    rows = read_evolved(spark, path).select(
        F.col("objectId").alias("objectid"), "candid", "publisher", "observation_timestamp",
        "observation_day",
    )
    return comparable(rows)


def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return run_summary(orders, "orders", "landing")


NIGHT = "2024-01-02"


def nightly_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of three files in nested folders, taken in as one night; the summary of the run beside
    what the landing folder and the payload table hold."""
    archive = new_stage_path(spark, "archive")
    alert_path, payload_path = new_stage_path(spark, "landing"), new_stage_path(spark, "payload")
    records = landing_records(spark, sf_dir).drop("observation_date")
    for n in range(3):
        part = records.where(F.substring("objectId", 5, 20).cast("bigint") % 3 == n)
        part.coalesce(1).write.parquet(f"{archive}/{n}/deeper")
    summary = ingest_night(spark, archive, NIGHT, alert_path, payload_path, "parquet", "*.parquet", records.schema)
    landed = read_landing(spark, alert_path, "parquet").agg(
        F.count("*").alias("n"), F.max("observation_date").alias("night")).first()
    return summary.drop("source", "destination").select(
        "*", F.lit(landed.n).cast("bigint").alias("n_landed"), F.lit(landed.night).alias("night"),
        F.lit(spark.read.parquet(payload_path).count()).cast("bigint").alias("n_images"))


def checksum_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six text files against a manifest file that has a third of them right and a third wrong."""
    folder, manifest = new_stage_path(spark, "files"), new_stage_path(spark, "manifest")
    part = (F.col("doc_id") % 6).cast("int")
    table(spark, sf_dir, "documents").repartitionById(6, part).select("text").write.text(folder)
    files = hash_files(spark, folder, "part-*")
    number = F.regexp_extract("path", "part-([0-9]+)", 1).cast("int")
    good = F.col("md5")
    wrong = F.when(number % 3 == 0, good).when(number % 3 == 1, F.reverse(good))
    lines = files.select(F.concat(wrong, F.lit("  ./"), F.col("path")).alias("value")).where("value IS NOT NULL")
    lines.coalesce(1).write.text(manifest)
    checked = verify_checksums(files, read_manifest(spark, manifest))
    return checked.select(
        F.regexp_extract("filename", "part-([0-9]+)", 1).cast("int").alias("part"), "status")


QUERIES = {
    "landing_partition_scan": landing_partition_scan,
    "landing_round_robin": landing_round_robin,
    "archive_scan": archive_scan,
    "tolerant_read": tolerant_read,
    "torn_lines": torn_lines,
    "drop_prefixed_columns": drop_prefixed_columns,
    "valid_record_filter": valid_record_filter,
    "valid_rows": valid_rows,
    "split_payload": split_payloads,
    "payload_keys": payload_keys,
    "payload_table": payload_table,
    "landing_ingest": landing_ingest,
    "manifest_parse": manifest_parse,
    "checksum_verify": checksum_verify,
    "bronze_alert": bronze_alerts,
    "bronze_append": bronze_append,
    "run_summary": ingest_summary,
    "nightly_ingest": nightly_ingest,
    "checksum_files": checksum_files,
}

_page = DAY.replace("k %", "page_id %")
_rec = f"""r AS (SELECT *, 'PAGE' || CAST(page_id AS VARCHAR) AS objectid, {_page} AS observation_date,
  CASE WHEN page_id % 19 <> 0 THEN page_id END AS candid,
  CASE WHEN page_id % 7 <> 0 THEN html END AS science,
  CASE WHEN page_id % 3 <> 0 AND page_id % 7 <> 0 THEN url END AS template,
  CASE WHEN page_id % 5 = 0 AND page_id % 7 <> 0 THEN reverse(url) END AS difference FROM pages)"""
_stamps = """s AS (
  SELECT candid, observation_date, 'cutoutScience' AS cutout_type, 'science' AS kind, science AS body FROM r
  UNION ALL SELECT candid, observation_date, 'cutoutTemplate', 'template', template FROM r
  UNION ALL SELECT candid, observation_date, 'cutoutDifference', 'difference', difference FROM r),
p AS (SELECT *, 'cutouts/' || CAST(candid AS VARCHAR) || '/' || CAST(candid AS VARCHAR) || '_' || kind
  || '.fits.gz' AS object_key FROM s WHERE candid IS NOT NULL AND body IS NOT NULL)"""
_manifest = """m AS (SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS filename,
  CASE WHEN doc_id % 14 = 0 THEN md5(text) WHEN doc_id % 7 = 0 THEN md5('other') ELSE md5(text) END AS md5
  FROM documents WHERE doc_id % 14 = 0 OR doc_id % 11 <> 0)"""
_page_jd = "(2460310.5::DOUBLE + (page_id % 30) + (page_id % 8640) / 8640::DOUBLE)"

ORACLE = {
    "landing_partition_scan": f"""WITH {A} SELECT objectid, candid, round(magpsf, 6) AS magpsf,
  observation_date FROM a""",
    "landing_round_robin": f"""WITH {A} SELECT observation_date, count(*) AS n_alerts,
  CAST(sum(candid) AS BIGINT) AS sum_candid, true AS few_files FROM a GROUP BY observation_date""",
    "archive_scan": f"WITH {A} SELECT objectid, candid, round(jd, 6) AS jd FROM a",
    "torn_lines": """WITH l AS (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 1 THEN '{"event_id":' || event_id || ',' ELSE '{' END
    || '"user_id":' || CASE WHEN event_id % 7 = 2 THEN '"none"' ELSE CAST(user_id AS VARCHAR) END
    || ',"event_type":"' || event_type || '"}' AS line FROM events),
r AS (SELECT CASE event_id % 7 WHEN 0 THEN 'torn' WHEN 1 THEN 'no key' WHEN 2 THEN 'wrong type' WHEN 3 THEN 'torn'
    WHEN 4 THEN 'no record' ELSE 'kept' END AS kind,
  CASE WHEN event_id % 7 > 4 THEN event_id END AS event_id, CASE WHEN event_id % 7 > 4 THEN user_id END AS user_id,
  CASE event_id % 7 WHEN 0 THEN line[:-4] WHEN 3 THEN line || line WHEN 4 THEN '[' || line || ']' WHEN 5 THEN NULL WHEN 6 THEN NULL
    ELSE line END AS line FROM l WHERE line IS NOT NULL)
SELECT *, count(*) FILTER (kind = 'kept') OVER () AS n_kept, count(*) FILTER (kind = 'torn') OVER () AS n_torn,
  count(*) FILTER (kind = 'no record') OVER () AS n_no_record, count(*) FILTER (kind = 'wrong type') OVER () AS n_wrong_type,
  count(*) FILTER (kind = 'no key') OVER () AS n_no_key FROM r""",
    "tolerant_read": f"""SELECT 'read' AS kind, {DAY.replace('k %', 'o_orderkey %')} AS observation_date,
  o_orderkey AS candid FROM orders
UNION ALL SELECT DISTINCT 'skipped', DATE '2024-01-31', CAST(NULL AS BIGINT) FROM documents""",
    "drop_prefixed_columns": f"""WITH {_rec} SELECT objectid, candid, round({_page_jd}, 6) AS jd,
  observation_date, 'objectId candid candidate prv_candidates fp_hists observation_date' AS columns_left FROM r""",
    "valid_record_filter": f"""WITH {_rec} SELECT count(*) AS n_records,
  count(*) FILTER (WHERE candid IS NULL) AS n_without_candid,
  count(*) FILTER (WHERE candid IS NOT NULL) AS n_kept,
  count(*) FILTER (WHERE candid IS NOT NULL AND science IS NULL AND template IS NULL
    AND difference IS NULL) AS n_without_payload FROM r""",
    "valid_rows": f"WITH {_rec} SELECT objectid, candid, observation_date FROM r WHERE candid IS NOT NULL",
    "split_payload": f"""WITH {_rec}, {_stamps} SELECT candid, cutout_type, md5(body) AS md5,
  CAST(strlen(body) AS BIGINT) AS n_bytes FROM p""",
    "payload_keys": f"WITH {_rec}, {_stamps} SELECT candid, cutout_type, object_key FROM p",
    "payload_table": f"WITH {_rec}, {_stamps} SELECT object_key, observation_date, md5(body) AS md5 FROM p",
    "landing_ingest": f"""WITH {_rec}, {_stamps},
c AS (SELECT observation_date, count(*) AS n_alerts, CAST(sum(2) AS BIGINT) AS n_history FROM r
  WHERE candid IS NOT NULL GROUP BY observation_date),
i AS (SELECT observation_date, count(*) AS n_payloads, CAST(sum(strlen(body)) AS BIGINT) AS n_bytes
  FROM p GROUP BY observation_date)
SELECT c.*, i.n_payloads, i.n_bytes FROM c LEFT JOIN i ON c.observation_date = i.observation_date""",
    "manifest_parse": f"WITH {_manifest} SELECT filename, md5 FROM m",
    "checksum_verify": f"""WITH {_manifest}, f AS (SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.txt'
  AS filename, md5(text) AS md5 FROM documents)
SELECT f.filename, f.md5, m.md5 AS expected_md5, CASE WHEN m.md5 IS NULL THEN 'no expected hash'
  WHEN m.md5 = f.md5 THEN 'match' ELSE 'mismatch' END AS status
FROM f LEFT JOIN m ON f.filename = m.filename""",
    "bronze_alert": f"""WITH {A} SELECT objectid, candid, fid, round(magnr, 6) AS magnr,
  observation_date, true AS stamped FROM a""",
    "bronze_append": f"""WITH {A} SELECT objectid, candid,
  CASE WHEN candid % 3 = 0 THEN 'second' END AS publisher, {seconds('jd')} AS observation_timestamp,
  DATE '1970-01-01' + CAST(floor(jd - 2440587.5::DOUBLE) AS INTEGER) AS observation_day FROM a""",
    "run_summary": """SELECT CAST(1 AS BIGINT) AS n_files, count(*) AS n_records, 'orders' AS source,
  'landing' AS destination, false AS skipped FROM orders""",
    "nightly_ingest": f"""WITH {_rec}
SELECT CAST(3 AS BIGINT) AS n_files, count(*) AS n_records, count(*) FILTER (candid IS NULL) AS n_without_candid,
  count(candid) AS n_kept,
  count(*) FILTER (candid IS NOT NULL AND science IS NULL AND template IS NULL AND difference IS NULL)
    AS n_without_payload, false AS skipped, count(candid) AS n_landed, DATE '{NIGHT}' AS night,
  CAST(sum(CASE WHEN candid IS NULL THEN 0 ELSE CAST(science IS NOT NULL AS INTEGER)
    + CAST(template IS NOT NULL AS INTEGER) + CAST(difference IS NOT NULL AS INTEGER) END) AS BIGINT) AS n_images
FROM r""",
    "checksum_files": """SELECT DISTINCT CAST(doc_id % 6 AS INTEGER) AS part, CASE doc_id % 3
  WHEN 0 THEN 'match' WHEN 1 THEN 'mismatch' ELSE 'no expected hash' END AS status FROM documents""",
}
