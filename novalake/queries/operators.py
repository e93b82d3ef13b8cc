"""Single operators over the alert-shaped inputs and the plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from novalake.fixtures import alerts, candidate_alerts, history_packets, table
from novalake.functions import photometry as ph
from novalake.functions.julian import jd_to_mjd, jd_to_timestamp
from novalake.functions.text import base_name, blank_separated_fields, difference_sign
from novalake.operators.combine import exclude_current, match_reference
from novalake.operators.dedupe import dedupe_by_key, first_non_null, top_row
from novalake.operators.reshape import (
    explode_fields,
    pad_union,
    stack_branches,
    unpivot_groups,
    with_audit,
)
from novalake.plans import silver
from novalake.plans.silver import BATCH
from novalake.queries.inputs import A, FP, H, mjd, r6
from novalake.queries.shown import comparable
from novalake.queries.silver_tables import (
    BEST,
    FORCED_VALUES,
    PS1_PARTS,
    QUALITY,
    REFERENCE_ROWS,
    SIGN,
    difference_sql,
    forced_sql,
)
from novalake.sources.tables import stage


def nested_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidate_alerts(spark, sf_dir).select(
        F.col("objectId").alias("objectid"), "candid", "candidate.jd", "candidate.magpsf",
        "candidate.ssnamenr",
    )
    return comparable(rows.withColumn("mjd", jd_to_mjd(F.col("jd"))).drop("jd"))


def struct_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = history_packets(spark, sf_dir).select("objectId", F.explode("fp_hists").alias("fp"))
    wide = packets.select(F.col("objectId").alias("objectid"), "fp.*")
    return comparable(wide.select(
        "objectid", "procstatus", "jd", "fid", "pid", "rfid", "forcediffimflux",
        "forcediffimfluxunc", "magzpsci", "magnr", "chinr", "exptime",
    ))


def explode_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_fields(
        history_packets(spark, sf_dir), "prv_candidates",
        ["candid", "jd", "fid", "pid", "diffmaglim", "isdiffpos"],
        [F.col("objectId").alias("objectid")],
    )
    kind = F.when(F.col("candid").isNull(), "upper limit").otherwise("detection")
    return comparable(rows.withColumn("kind", kind))


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.history_detections(history_packets(spark, sf_dir), BATCH)
    return comparable(rows.select(
        *BATCH, "objectid", "candid", "jd", "fid", "pid", "isdiffpos", "magpsf", "distnr"
    ))


def anti_join_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = silver.history_detections(history_packets(spark, sf_dir), BATCH)
    current = silver.current_detections(candidate_alerts(spark, sf_dir), BATCH)
    rows = exclude_current(history, current, [*BATCH, "candid"])
    return comparable(rows.select(*BATCH, "objectid", "candid", "pid", "magpsf"))


def null_padded_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*BATCH, "objectid", "candid", "fid", "isdiffpos", "magpsf"]
    every = alerts(spark, sf_dir)
    current = silver.current_detections(every, BATCH).select(*columns, "rfid", "drbversion", "exptime")
    history = silver.history_detections(every, BATCH).select(*columns)
    return comparable(pad_union(current, history).distinct())


def reference_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = candidate_alerts(spark, sf_dir)
    rows = silver.current_detections(every, BATCH).select(
        *BATCH, "objectid", "fid", "rfid", "candid", "distnr"
    )
    joined = match_reference(
        rows, stage(silver.reference(every, BATCH), "reference"), [*BATCH, "objectid", "fid", "rfid"],
        ["magnr", "sigmagnr"], F.col("distnr") < F.lit(silver.MATCH_RADIUS),
    )
    return comparable(joined)


def dedupe_first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidate_alerts(spark, sf_dir).select(
        F.col("objectId").alias("objectid"), "candid", "candidate.chinr", "candidate.maggaia",
        "candidate.distnr", "candidate.ssnamenr",
    )
    return comparable(first_non_null(
        rows, ["objectid"], ["chinr", "maggaia", "distnr", "ssnamenr"], F.col("candid")
    ))


def keyed_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper limits by key; the pid is blanked for some, and such rows all stay."""
    limits = silver.non_detection(history_packets(spark, sf_dir)).select(
        "objectid", "fid", F.when(F.col("pid") % 7 != 0, F.col("pid")).alias("pid"), "mjd",
        "diffmaglim",
    )
    return comparable(dedupe_by_key(limits, ["objectid", "fid", "pid", "mjd"]))


def top1_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.best_measurement(
        silver.forced_measurements(history_packets(spark, sf_dir), BATCH), BATCH
    )
    return comparable(rows.select(
        *BATCH, "objectid", "fid", "pid", "rfid", "jd", "snr", "forcediffimflux",
        "forcediffimfluxunc",
    ))


def best_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    best = top_row(
        events, ["user_id", "event_type"],
        [F.col("value").desc_nulls_last(), F.col("event_id").asc()],
    )
    return best.select("user_id", "event_type", "event_id", "value")


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.forced_measurements(history_packets(spark, sf_dir), BATCH)
    return comparable(rows.select(
        *BATCH, "objectid", "pid", "rfid", "forcediffimflux", "forcediffimfluxunc", "chinr", "magnr"
    ))


_PS1_COLUMNS = [*BATCH, "candid", "objectid", "objectidps", "sgmag", "distpsnr"]


def unpivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.ps1_matches(candidate_alerts(spark, sf_dir), BATCH)
    return comparable(rows.select(*_PS1_COLUMNS, "match_no"))


def union_all_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by UNION ALL; reads the table once per branch."""
    matched = candidate_alerts(spark, sf_dir).where("candidate.nmtchps > 0")
    branches = [
        matched.select(
            *BATCH, "candid", F.col("objectId").alias("objectid"),
            F.col(f"candidate.objectidps{i}").alias("objectidps"),
            F.col(f"candidate.sgmag{i}").alias("sgmag"),
            F.col(f"candidate.distpsnr{i}").alias("distpsnr"),
            F.lit(i).alias("match_no"),
        ).where(F.col("objectidps").isNotNull())
        for i in (1, 2, 3)
    ]
    return comparable(stack_branches(branches))


def unpivot_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return unpivot_groups(
        items,
        [
            {"kind": F.lit("discount"), "amount": F.when(F.col("l_discount") > 0, F.col("l_discount"))},
            {"kind": F.lit("tax"), "amount": F.when(F.col("l_tax") > 0, F.col("l_tax"))},
        ],
        required="amount",
        keep=["l_orderkey", "l_linenumber"],
    )


def flag_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidate_alerts(spark, sf_dir).select("candid", F.col("candidate.isdiffpos").alias("flag"))
    return rows.withColumn("isdiffpos", difference_sign(F.col("flag")))


def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    urgent = F.when(priority.startswith("1-"), "urgent").when(
        F.lower(F.trim(priority)).contains("not specified"), "unknown"
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lower(F.trim(F.concat(F.lit("  "), priority, F.lit(" ")))).alias("priority"),
        F.replace(priority, F.lit("-"), F.lit("_")).alias("code"),
        urgent.alias("kind"),
        F.when(F.when(priority.startswith("1-"), F.lit(True)), "first").otherwise("later").alias("queue"),
    )


def path_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White-space fields of whole texts, and the last path component of URLs."""
    docs = table(spark, sf_dir, "documents")
    parts = docs.select("doc_id", F.lit("text").alias("kind"),
                        blank_separated_fields(F.col("text")).alias("parts"))
    fields = parts.select(
        "doc_id", "kind", F.size("parts").cast("bigint").alias("n_fields"),
        F.try_element_at("parts", F.lit(-1)).alias("last"),
    )
    urls = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"), F.lit("url").alias("kind"),
        F.length("url").cast("bigint").alias("n_fields"), base_name(F.col("url")).alias("last"),
    )
    return fields.unionByName(urls)


def jd_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    rows = table(spark, sf_dir, "events").select(
        "event_id", (epoch / F.lit(86400.0) + F.lit(2440587.5)).alias("jd")
    )
    return rows.select(
        "event_id",
        F.round(jd_to_mjd(F.col("jd")), 6).alias("mjd"),
        F.round(F.unix_micros(jd_to_timestamp(F.col("jd"))) / F.lit(1e6)).cast("bigint").alias("ts"),
        F.to_date(F.timestamp_seconds(F.round((F.col("jd") - 2440587.5) * 86400.0))).alias("day"),
    )


def difference_photometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidate_alerts(spark, sf_dir).select(
        "candid", "candidate.magpsf", "candidate.sigmapsf", "candidate.magnr", "candidate.sigmagnr",
        difference_sign(F.col("candidate.isdiffpos")).alias("isdiffpos"),
    )
    return comparable(silver.difference_photometry(rows))


def forced_photometry_maths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable measurement, not only the best one per exposure."""
    rows = silver.forced_measurements(history_packets(spark, sf_dir))
    values = silver.forced_photometry_values(rows)
    return comparable(values.select(
        "objectid", "pid", "fid", "rfid", "jd", *FORCED_VALUES.replace(" ", "").split(",")
    ))


def calibrated_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corrected magnitude error, only on request."""
    rows = silver.forced_measurements(history_packets(spark, sf_dir))
    values = silver.forced_photometry_values(rows, calibrated_error=True)
    return comparable(values.select("objectid", "pid", "jd", "total_flux_ujy", "apparent_mag_err"))


def flux_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    rows = table(spark, sf_dir, "part").select("p_partkey", price, ph.magnitude(price).alias("mag"))
    return rows.select(
        "p_partkey", F.round("mag", 6).alias("mag"), F.round(ph.flux(F.col("mag")), 6).alias("flux"),
        F.round(ph.instrument_magnitude(F.lit(26.0), price - F.round(price)), 6).alias("counts_mag"),
    )


def audit_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = with_audit(table(spark, sf_dir, "events"))
    return stamped.select(
        "event_id", "event_type", F.col("_created_ts").isNotNull().alias("stamped"),
        (F.col("_created_ts") > F.col("ts").cast("timestamp")).alias("after_event"),
    )


QUERIES = {
    "nested_projection": nested_projection,
    "struct_expand": struct_expand,
    "explode_history": explode_history,
    "distinct_rows": distinct_rows,
    "anti_join_history": anti_join_history,
    "null_padded_union": null_padded_union,
    "reference_left_join": reference_left_join,
    "dedupe_first_non_null": dedupe_first_non_null,
    "dedupe_by_key": keyed_dedupe,
    "top1_measurement": top1_measurement,
    "top1_event": best_event,
    "quality_filter": quality_filter,
    "unpivot_groups": unpivoted,
    "unpivot_prices": unpivot_prices,
    "union_all_branches": union_all_branches,
    "flag_decode": flag_decode,
    "text_normalise": text_normalise,
    "path_fields": path_fields,
    "jd_conversions": jd_conversions,
    "difference_photometry": difference_photometry,
    "forced_photometry_maths": forced_photometry_maths,
    "calibrated_error": calibrated_error,
    "flux_round_trip": flux_round_trip,
    "audit_column": audit_column,
}

_ps1 = f"""WITH {A}, parts AS ({PS1_PARTS})
SELECT observation_date, candid, objectid, objectidps, {r6('sgmag')} AS sgmag,
  {r6('distpsnr')} AS distpsnr, CAST(match_no AS INTEGER) AS match_no FROM parts"""
_old = """old AS (SELECT DISTINCT observation_date, objectid, candid, jd, fid, pid, %s, magpsf, distnr
  FROM h WHERE candid IS NOT NULL)""" % SIGN
_zp = "(pow(10::DOUBLE, 3.56::DOUBLE) * 1000000::DOUBLE)"

ORACLE = {
    "nested_projection": f"""WITH {A} SELECT objectid, candid, {r6('magpsf')} AS magpsf, ssnamenr,
  {mjd('jd')} AS mjd FROM a""",
    "struct_expand": f"""WITH {FP} SELECT objectid, procstatus, {r6('jd')} AS jd, fid, pid, rfid,
  {r6('forcediffimflux')} AS forcediffimflux, {r6('forcediffimfluxunc')} AS forcediffimfluxunc,
  {r6('magzpsci')} AS magzpsci, {r6('magnr')} AS magnr, {r6('chinr')} AS chinr,
  {r6('exptime')} AS exptime FROM fp""",
    "explode_history": f"""WITH {H} SELECT objectid, candid, {r6('jd')} AS jd, fid, pid,
  {r6('diffmaglim')} AS diffmaglim, isdiffpos,
  CASE WHEN candid IS NULL THEN 'upper limit' ELSE 'detection' END AS kind FROM h""",
    "distinct_rows": f"""WITH {H}, {_old} SELECT observation_date, objectid, candid, {r6('jd')} AS jd,
  fid, pid, isdiffpos, {r6('magpsf')} AS magpsf, {r6('distnr')} AS distnr FROM old""",
    "anti_join_history": f"""WITH {A}, {H}, {_old}
SELECT observation_date, objectid, candid, pid, {r6('magpsf')} AS magpsf FROM old
WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.candid = old.candid AND a.observation_date = old.observation_date)""",
    "null_padded_union": f"""WITH {A}, {H}
SELECT observation_date, objectid, candid, fid, {SIGN}, {r6('magpsf')} AS magpsf, rfid, drbversion,
  {r6('exptime')} AS exptime FROM a WHERE candid IS NOT NULL
UNION
SELECT observation_date, objectid, candid, fid, {SIGN}, {r6('magpsf')} AS magpsf, NULL, NULL, NULL
FROM h WHERE candid IS NOT NULL""",
    "reference_left_join": f"""WITH {A}, {REFERENCE_ROWS}
SELECT a.observation_date, a.objectid, a.fid, a.rfid, a.candid, {r6('a.distnr')} AS distnr,
  {r6('ref.magnr')} AS magnr, {r6('ref.sigmagnr')} AS sigmagnr
FROM a LEFT JOIN ref ON a.observation_date = ref.observation_date AND a.objectid = ref.objectid
  AND a.fid = ref.fid AND a.rfid = ref.rfid AND a.distnr < CAST(1.4 AS DOUBLE)""",
    "dedupe_first_non_null": f"""WITH {A} SELECT objectid, round(arg_min(chinr, candid), 6) AS chinr,
  round(arg_min(maggaia, candid), 6) AS maggaia, round(arg_min(distnr, candid), 6) AS distnr,
  arg_min(ssnamenr, candid) AS ssnamenr FROM a GROUP BY objectid""",
    "dedupe_by_key": f"""WITH {H}, l AS (SELECT objectid, fid, CASE WHEN pid % 7 <> 0 THEN pid END AS pid,
  jd - 2400000.5::DOUBLE AS mjd, diffmaglim FROM h WHERE candid IS NULL)
SELECT objectid, fid, pid, {r6('mjd')} AS mjd, round(max(diffmaglim), 6) AS diffmaglim FROM l
WHERE pid IS NOT NULL GROUP BY objectid, fid, pid, l.mjd
UNION ALL SELECT objectid, fid, pid, {r6('mjd')} AS mjd, {r6('diffmaglim')} AS diffmaglim FROM l WHERE pid IS NULL""",
    "top1_measurement": f"""WITH {FP}, {BEST} SELECT observation_date, objectid, fid, pid, rfid,
  {r6('jd')} AS jd, snr, {r6('forcediffimflux')} AS forcediffimflux,
  {r6('forcediffimfluxunc')} AS forcediffimfluxunc FROM best""",
    "top1_event": """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC NULLS LAST, event_id) = 1""",
    "quality_filter": f"""WITH {FP} SELECT observation_date, objectid, pid, rfid,
  {r6('forcediffimflux')} AS forcediffimflux, {r6('forcediffimfluxunc')} AS forcediffimfluxunc,
  {r6('chinr')} AS chinr, {r6('magnr')} AS magnr FROM fp WHERE {QUALITY}""",
    "unpivot_groups": _ps1,
    "union_all_branches": _ps1,
    "unpivot_prices": """SELECT l_orderkey, l_linenumber, 'discount' AS kind, l_discount AS amount
FROM lineitem WHERE l_discount > 0
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem WHERE l_tax > 0""",
    "flag_decode": f"WITH {A} SELECT candid, isdiffpos AS flag, {SIGN} FROM a",
    "text_normalise": """SELECT o_orderkey, lower(trim('  ' || o_orderpriority || ' ')) AS priority,
  replace(o_orderpriority, '-', '_') AS code,
  CASE WHEN starts_with(o_orderpriority, '1-') THEN 'urgent'
    WHEN contains(lower(trim(o_orderpriority)), 'not specified') THEN 'unknown' END AS kind,
  CASE WHEN CASE WHEN starts_with(o_orderpriority, '1-') THEN true END THEN 'first' ELSE 'later' END AS queue
FROM orders""",
    "path_fields": r"""WITH p AS (SELECT doc_id, regexp_split_to_array(
    regexp_replace(text, '^[\s\x0b\x1c-\x1f\x{85}\p{Z}]+|[\s\x0b\x1c-\x1f\x{85}\p{Z}]+$', '', 'g'),
    '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+') AS parts FROM documents),
q AS (SELECT doc_id, CASE WHEN parts = [''] THEN [] ELSE parts END AS parts FROM p)
SELECT doc_id, 'text' AS kind, CAST(len(parts) AS BIGINT) AS n_fields, parts[-1] AS last FROM q
UNION ALL
SELECT page_id, 'url', CAST(length(url) AS BIGINT),
  regexp_extract(regexp_replace(url, '(/\.?)+$', ''), '[^/]*$') FROM pages""",
    "jd_conversions": """WITH j AS (SELECT event_id,
  epoch_us(ts) / 1000000::DOUBLE / 86400::DOUBLE + 2440587.5::DOUBLE AS jd FROM events)
SELECT event_id, round(jd - 2400000.5::DOUBLE, 6) AS mjd,
  CAST(round((jd - 2440587.5::DOUBLE) * 86400::DOUBLE) AS BIGINT) AS ts,
  DATE '1970-01-01' + CAST(floor(round((jd - 2440587.5::DOUBLE) * 86400::DOUBLE) / 86400) AS INTEGER) AS day
FROM j""",
    "difference_photometry": f"""WITH {A},
c AS (SELECT candid, magpsf, sigmapsf, magnr, sigmagnr, {SIGN} FROM a), {difference_sql('c')}
SELECT * REPLACE ({r6('magpsf')} AS magpsf, {r6('sigmapsf')} AS sigmapsf, {r6('magnr')} AS magnr,
  {r6('sigmagnr')} AS sigmagnr) FROM flux4""",
    "forced_photometry_maths": f"""WITH {FP},
good AS (SELECT *, forcediffimflux / forcediffimfluxunc AS snr FROM fp WHERE {QUALITY}), {forced_sql('good')}
SELECT objectid, pid, fid, rfid, {r6('jd')} AS jd, {FORCED_VALUES} FROM f3""",
    "calibrated_error": f"""WITH {FP},
t AS (SELECT *, {_zp} * pow(10::DOUBLE, -0.4::DOUBLE * magzpsci) * forcediffimflux
    + {_zp} * pow(10::DOUBLE, -0.4::DOUBLE * magnr) AS tot,
  {_zp} * pow(10::DOUBLE, -0.4::DOUBLE * magzpsci) * forcediffimfluxunc AS fe FROM fp WHERE {QUALITY})
SELECT objectid, pid, {r6('jd')} AS jd, {r6('tot')} AS total_flux_ujy,
  CASE WHEN tot > 0 THEN round((2.5::DOUBLE / ln(10::DOUBLE)) * fe / tot, 6) END AS apparent_mag_err FROM t""",
    "flux_round_trip": f"""WITH m AS (SELECT p_partkey, p_retailprice AS price,
  -2.5::DOUBLE * log10(p_retailprice / {_zp}) AS mag, abs(p_retailprice - round(p_retailprice)) AS rest FROM part)
SELECT p_partkey, round(mag, 6) AS mag, round({_zp} * pow(10::DOUBLE, -0.4::DOUBLE * mag), 6) AS flux,
  CASE WHEN rest > 0 THEN round(26::DOUBLE - 2.5::DOUBLE * log10(CASE WHEN rest > 0 THEN rest END), 6) END AS counts_mag
FROM m""",
    "audit_column": "SELECT event_id, event_type, true AS stamped, true AS after_event FROM events",
}
