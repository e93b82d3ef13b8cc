"""The seven silver tables over all batches, each row meeting only its batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, FloatType

from novalake.fixtures import alerts, candidate_alerts, history_packets
from novalake.operators.dedupe import latest_per_key
from novalake.plans import silver
from novalake.plans.silver import BATCH
from novalake.queries.inputs import A, FP, H, mjd, r6, seconds
from novalake.queries.shown import comparable
from novalake.schemas import CANDIDATE, FORCED, HISTORY
from novalake.sources.tables import stage


def gaia(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver.crossmatch_gaia(candidate_alerts(spark, sf_dir), BATCH))


def solar_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver.crossmatch_ss(candidate_alerts(spark, sf_dir), BATCH))


def ps1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver.crossmatch_ps1(candidate_alerts(spark, sf_dir), BATCH))


def non_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver.non_detection(history_packets(spark, sf_dir), BATCH))


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver.reference(candidate_alerts(spark, sf_dir), BATCH))


def detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads the reference values from a written table, as the refresh does."""
    values = silver.reference(candidate_alerts(spark, sf_dir), BATCH).select(
        *BATCH, "objectid", "fid", "rfid", "magnr", "sigmagnr"
    )
    references = stage(values, "reference")
    return comparable(silver.detection(alerts(spark, sf_dir), references, BATCH))


def forced_photometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver.forced_photometry(history_packets(spark, sf_dir), BATCH))


def batch_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.reference(candidate_alerts(spark, sf_dir), BATCH)
    return comparable(latest_per_key(rows, ["objectid", "fid", "rfid"]))


QUERIES = {
    "crossmatch_gaia": gaia,
    "crossmatch_ps1": ps1,
    "crossmatch_ss": solar_system,
    "non_detection": non_detection,
    "reference": reference,
    "detection": detection,
    "forced_photometry": forced_photometry,
    "batch_backfill": batch_backfill,
}


def _listed(names, *schemas) -> str:
    """Column list with float and double columns rounded."""
    kinds = {f.name: f.dataType for schema in schemas for f in schema.fields}
    return ", ".join(
        f"{r6(n)} AS {n}" if isinstance(kinds[n], (FloatType, DoubleType)) else n for n in names
    )


ZP = "(pow(10::DOUBLE, 3.56::DOUBLE) * 1000000::DOUBLE)"
K1 = "(0.4::DOUBLE * ln(10::DOUBLE))"
K2 = "(2.5::DOUBLE / ln(10::DOUBLE))"


def flux(mag: str) -> str:
    return f"({ZP} * pow(10::DOUBLE, -0.4::DOUBLE * {mag}))"


def magnitude(total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN -2.5::DOUBLE * log10(CASE WHEN {total} > 0 THEN {total} END / {ZP}) END"


def difference_sql(rows: str) -> str:
    """``rows`` with fluxes and magnitudes; three steps, each naming the next."""
    return f"""
flux1 AS (SELECT *, {flux('magpsf')} AS f, {flux('magnr')} AS r FROM {rows}),
flux2 AS (SELECT *, {K1} * sigmapsf * f AS fe, {K1} * sigmagnr * r AS re,
  CASE WHEN isdiffpos THEN r + f ELSE r - f END AS tot FROM flux1),
flux3 AS (SELECT *, sqrt(pow(fe, 2) + pow(re, 2)) AS te FROM flux2),
flux4 AS (SELECT * EXCLUDE (f, r, fe, re, tot, te),
  {r6('f')} AS diff_flux_ujy, {r6('fe')} AS diff_flux_err_ujy, {r6('tot')} AS total_flux_ujy,
  {r6('te')} AS total_flux_err_ujy, round({magnitude('tot')}, 6) AS apparent_mag,
  CASE WHEN tot > 0 THEN round({K2} * te / tot, 6) END AS apparent_mag_err FROM flux3)"""


SIGN = ("CASE WHEN lower(trim(isdiffpos)) IN ('t', '1') THEN true "
        "WHEN lower(trim(isdiffpos)) IN ('f', '0') THEN false END AS isdiffpos")

_first = ", ".join(f"arg_min({c}, match_no) AS {c}" for c in silver.PS1_FIELDS)
_ps1_parts = " UNION ALL ".join(
    f"SELECT observation_date, candid, objectid, jd, {i} AS match_no, objectidps{i} AS objectidps, "
    + ", ".join(f"{c}{i} AS {c}" for c in silver.PS1_FIELDS)
    + f" FROM a WHERE nmtchps > 0 AND objectidps{i} IS NOT NULL"
    for i in (1, 2, 3)
)
PS1_PARTS = _ps1_parts

REFERENCE_ROWS = (
    "ref AS (SELECT observation_date, objectid, fid, rfid, "
    + ", ".join(f"arg_min({c}, candid) AS {c}" for c in silver.REFERENCE_FIELDS)
    + " FROM a GROUP BY observation_date, objectid, fid, rfid)"
)
_reference_shown = (
    "observation_date, objectid, fid, rfid, "
    + _listed("rcid field magnr sigmagnr chinr sharpnr ranr decnr".split(), CANDIDATE)
    + f", {mjd('jdstartref')} AS mjdstartref, {mjd('jdendref')} AS mjdendref, "
    f"{seconds('jdstartref')} AS startref_ts, {seconds('jdendref')} AS endref_ts, nframesref"
)

_carried = [c for c in silver.HISTORY_FIELDS if c != "isdiffpos"]
_types = {f.name: f.dataType.simpleString() for f in CANDIDATE.fields}
_sql_types = {"float": "DOUBLE", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR"}
_no_values = ", ".join(
    f"CAST(NULL AS {_sql_types[_types[c]]}) AS {c}" for c in silver.CURRENT_ONLY_FIELDS
)


def detection_sql(history: str) -> str:
    common = f"observation_date, objectid, candid, jd, {SIGN}, {', '.join(_carried)}"
    shown = [c for c in silver.DETECTION_COLUMNS if c not in ("mjd", "ts", "candid", "objectid", "isdiffpos")]
    photometry = shown[shown.index("diff_flux_ujy"):]
    measured = shown[: shown.index("diff_flux_ujy")]
    return f"""WITH {A}, {history}, {REFERENCE_ROWS},
cur AS (SELECT {common}, {', '.join(silver.CURRENT_ONLY_FIELDS)} FROM a WHERE candid IS NOT NULL),
old AS (SELECT DISTINCT {common}, {_no_values} FROM h WHERE candid IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM a WHERE a.candid = h.candid AND a.observation_date = h.observation_date)),
every AS (SELECT * FROM cur UNION SELECT * FROM old),
matched AS (SELECT every.*, ref.magnr, ref.sigmagnr FROM every LEFT JOIN ref
  ON every.observation_date = ref.observation_date AND every.objectid = ref.objectid
  AND every.fid = ref.fid AND every.rfid = ref.rfid AND every.distnr < CAST(1.4 AS DOUBLE)),
{difference_sql('matched')}
SELECT observation_date, candid, objectid, {mjd('jd')} AS mjd, isdiffpos,
  {_listed(measured, CANDIDATE)}, {', '.join(photometry)}, {seconds('jd')} AS ts
FROM flux4"""


QUALITY = "procstatus = '0' AND " + " AND ".join(
    f"{c} IS NOT NULL AND {c} <> -99999" for c in silver.FORCED_MEASURED
) + " AND forcediffimfluxunc > 0"
BEST = f"""best AS (SELECT *, forcediffimflux / forcediffimfluxunc AS snr FROM fp WHERE {QUALITY}
  QUALIFY row_number() OVER (PARTITION BY observation_date, objectid, fid, pid, rfid
    ORDER BY abs(forcediffimflux / forcediffimfluxunc) DESC, forcediffimfluxunc, jd, forcediffimflux) = 1)"""


def forced_sql(rows: str) -> str:
    return f"""
f1 AS (SELECT *, {flux('magzpsci')} * forcediffimflux AS f, {flux('magzpsci')} * forcediffimfluxunc AS fe FROM {rows}),
f2 AS (SELECT *, {flux('magnr')} + f AS tot FROM f1),
f3 AS (SELECT *,
  CASE WHEN abs(forcediffimflux) > 0 THEN
    round(magzpsci - 2.5::DOUBLE * log10(CASE WHEN abs(forcediffimflux) > 0 THEN abs(forcediffimflux) END), 6) END AS magpsf,
  CASE WHEN abs(forcediffimflux) > 1e-9 THEN round({K2} * forcediffimfluxunc / abs(forcediffimflux), 6) END AS sigmapsf,
  {r6('f')} AS diff_flux_ujy, {r6('fe')} AS diff_flux_err_ujy, {r6('tot')} AS total_flux_ujy,
  round({magnitude('tot')}, 6) AS apparent_mag,
  CASE WHEN tot > 0 THEN round({K2} * forcediffimfluxunc / abs(tot), 6) END AS apparent_mag_err FROM f2)"""


FORCED_VALUES = ("snr, magpsf, sigmapsf, diff_flux_ujy, diff_flux_err_ujy, total_flux_ujy, "
                 "apparent_mag, apparent_mag_err")

ORACLE = {
    "crossmatch_gaia": f"""WITH {A}
SELECT observation_date, candid, objectid, {_listed(silver.GAIA_FIELDS, CANDIDATE)}, {seconds('jd')} AS ts
FROM a WHERE neargaia IS NOT NULL AND neargaiabright IS NOT NULL AND maggaia IS NOT NULL
  AND maggaiabright IS NOT NULL AND neargaia > 0 AND neargaiabright > 0""",
    "crossmatch_ss": f"""WITH {A}
SELECT observation_date, candid, objectid, {_listed(silver.SOLAR_SYSTEM_FIELDS, CANDIDATE)}, {seconds('jd')} AS ts
FROM a WHERE ssdistnr IS NOT NULL AND ssmagnr IS NOT NULL AND ssnamenr IS NOT NULL
  AND ssdistnr > 0 AND ssmagnr > 0""",
    "crossmatch_ps1": f"""WITH {A}, parts AS ({_ps1_parts}),
uniq AS (SELECT observation_date, candid, objectidps, arg_min(objectid, match_no) AS objectid,
  arg_min(jd, match_no) AS jd, {_first} FROM parts GROUP BY observation_date, candid, objectidps)
SELECT observation_date, candid, objectid, objectidps,
  {', '.join(f'{r6(c)} AS {c}' for c in silver.PS1_FIELDS)}, {seconds('jd')} AS ts FROM uniq""",
    "non_detection": f"""WITH {H}
SELECT observation_date, objectid, {mjd('jd')} AS mjd, {_listed(silver.UPPER_LIMIT_FIELDS, HISTORY)},
  {seconds('jd')} AS ts FROM h WHERE candid IS NULL""",
    "reference": f"WITH {A}, {REFERENCE_ROWS} SELECT {_reference_shown} FROM ref",
    "batch_backfill": f"""WITH {A}, {REFERENCE_ROWS},
latest AS (SELECT * FROM ref QUALIFY row_number() OVER
  (PARTITION BY objectid, fid, rfid ORDER BY observation_date DESC) = 1)
SELECT {_reference_shown} FROM latest""",
    "detection": detection_sql(H),
    "forced_photometry": f"""WITH {FP}, {BEST}, {forced_sql('best')}
SELECT observation_date, objectid, {mjd('jd')} AS mjd, {_listed(silver.FORCED_FIELDS, FORCED)},
  {FORCED_VALUES}, {seconds('jd')} AS ts FROM f3""",
}
