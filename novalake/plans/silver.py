"""Silver tables: alerts in, one table's rows out.

Every function computes one batch. ``per`` names batch columns (normally
``observation_date``) for running many batches in one job: rows then only meet
rows of their own batch, which gives what a loop over the days would give.
The audit column is added by the writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from novalake.functions import photometry as ph
from novalake.functions.julian import jd_to_mjd, jd_to_timestamp
from novalake.functions.predicates import all_measured, all_positive, all_present
from novalake.functions.text import difference_sign
from novalake.operators.combine import exclude_current, match_reference
from novalake.operators.dedupe import first_non_null, top_row
from novalake.operators.reshape import explode_fields, pad_union, unpivot_groups

BATCH = ("observation_date",)

# Measured columns of each table, in output order.
GAIA_FIELDS = "neargaia neargaiabright maggaia maggaiabright".split()
SOLAR_SYSTEM_FIELDS = "ssdistnr ssmagnr ssnamenr".split()
PS1_FIELDS = "sgmag srmag simag szmag sgscore distpsnr".split()
UPPER_LIMIT_FIELDS = (
    "fid pid diffmaglim nid rcid field magzpsci magzpsciunc magzpscirms clrcoeff clrcounc".split()
)
REFERENCE_FIELDS = (
    "rcid field magnr sigmagnr chinr sharpnr ranr decnr jdstartref jdendref nframesref".split()
)
HISTORY_FIELDS = """
    fid pid diffmaglim isdiffpos nid xpos ypos ra dec magpsf sigmapsf chipsf magap sigmagap
    distnr sky fwhm classtar mindtoedge seeratio aimage bimage aimagerat bimagerat nneg nbad
    rb rbversion sumrat magapbig sigmagapbig scorr magzpsci magzpsciunc
""".split()
CURRENT_ONLY_FIELDS = """
    drb drbversion rfid dsnrms ssnrms magzpscirms nmatches clrcoeff clrcounc zpclrcov zpmed
    clrmed clrrms exptime
""".split()
DETECTION_COLUMNS = """
    candid objectid mjd fid pid diffmaglim isdiffpos nid xpos ypos ra dec magpsf sigmapsf chipsf
    magap sigmagap distnr magnr sigmagnr sky fwhm classtar mindtoedge seeratio aimage bimage
    aimagerat bimagerat nneg nbad rb rbversion drb drbversion sumrat magapbig sigmagapbig scorr
    rfid dsnrms ssnrms magzpsci magzpsciunc magzpscirms nmatches clrcoeff clrcounc zpclrcov zpmed
    clrmed clrrms exptime diff_flux_ujy diff_flux_err_ujy total_flux_ujy total_flux_err_ujy
    apparent_mag apparent_mag_err ts
""".split()
FORCED_FIELDS = """
    field rcid fid pid rfid sciinpseeing scibckgnd scisigpix magzpsci magzpsciunc magzpscirms
    clrcoeff clrcounc exptime adpctdif1 adpctdif2 diffmaglim forcediffimflux forcediffimfluxunc
    distnr ranr decnr magnr sigmagnr chinr sharpnr
""".split()
FORCED_MEASURED = """
    forcediffimflux forcediffimfluxunc distnr ranr decnr magnr sigmagnr chinr sharpnr
""".split()

# A reference source counts as the same object within this many
# pixels; status of a good forced measurement.
MATCH_RADIUS = 1.4
GOOD_STATUS = "0"


def _candidate(*fields: str) -> list[str]:
    """Struct fields as columns of the same name."""
    return [f"candidate.{f}" for f in fields]


def _object_id():
    return F.col("objectId").alias("objectid")


def _nearest_catalogue(
    alerts: DataFrame, fields: Sequence[str], positive: Sequence[str], per: Sequence[str]
) -> DataFrame:
    path = [f"candidate.{f}" for f in fields]
    return alerts.where(
        all_present(*path) & all_positive(*(f"candidate.{f}" for f in positive))
    ).select(
        *per, "candid", _object_id(), *_candidate(*fields),
        jd_to_timestamp(F.col("candidate.jd")).alias("ts"),
    )


def crossmatch_gaia(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    return _nearest_catalogue(alerts, GAIA_FIELDS, ["neargaia", "neargaiabright"], per)


def crossmatch_ss(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    return _nearest_catalogue(alerts, SOLAR_SYSTEM_FIELDS, ["ssdistnr", "ssmagnr"], per)


def ps1_matches(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """One row per alert and listed neighbour, with its position in the list."""
    groups = [
        {"objectidps": f"candidate.objectidps{i}"}
        | {f: f"candidate.{f}{i}" for f in PS1_FIELDS}
        for i in (1, 2, 3)
    ]
    return unpivot_groups(
        alerts.where(F.col("candidate.nmtchps") > 0),
        groups,
        required="objectidps",
        keep=[*per, "candid", _object_id(), *_candidate("jd")],
        position="match_no",
    )


def crossmatch_ps1(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """A neighbour listed twice gives one row; the earlier listing goes first."""
    unique = first_non_null(
        ps1_matches(alerts, per),
        [*per, "candid", "objectidps"],
        ["objectid", "jd", *PS1_FIELDS],
        F.col("match_no"),
    )
    return unique.select(
        *per, "candid", "objectid", "objectidps", *PS1_FIELDS,
        jd_to_timestamp(F.col("jd")).alias("ts"),
    )


def non_detection(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """History entries without an alert id are upper limits."""
    limits = explode_fields(
        alerts, "prv_candidates", ["candid", "jd", *UPPER_LIMIT_FIELDS], [*per, _object_id()]
    ).where(F.col("candid").isNull())
    return limits.select(
        *per, "objectid", jd_to_mjd(F.col("jd")).alias("mjd"), *UPPER_LIMIT_FIELDS,
        jd_to_timestamp(F.col("jd")).alias("ts"),
    )


def reference(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Reference-image values per object, filter and image: earliest alert first."""
    rows = alerts.select(*per, "candid", _object_id(), *_candidate("fid", "rfid", *REFERENCE_FIELDS))
    unique = first_non_null(
        rows,
        [*per, "objectid", "fid", "rfid"],
        REFERENCE_FIELDS,
        F.coalesce(F.col("candid"), F.lit(2**63 - 1)),
    )
    start, end = F.col("jdstartref"), F.col("jdendref")
    return unique.select(
        *per, "objectid", "fid", "rfid",
        *(f for f in REFERENCE_FIELDS if f not in ("jdstartref", "jdendref", "nframesref")),
        jd_to_mjd(start).alias("mjdstartref"), jd_to_mjd(end).alias("mjdendref"),
        jd_to_timestamp(start).alias("startref_ts"), jd_to_timestamp(end).alias("endref_ts"),
        "nframesref",
    )


def current_detections(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    rows = alerts.where(F.col("candidate.candid").isNotNull()).select(
        *per, _object_id(), *_candidate("candid", "jd", *HISTORY_FIELDS, *CURRENT_ONLY_FIELDS)
    )
    return rows.withColumn("isdiffpos", difference_sign(F.col("isdiffpos")))


def history_detections(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Earlier detections carried along by the alerts, one row per distinct copy.

    The same detection travels with every later alert of its object, so the
    copies are collapsed (map-side first) before anything is joined.
    """
    rows = explode_fields(
        alerts, "prv_candidates", ["candid", "jd", *HISTORY_FIELDS], [*per, _object_id()]
    ).where(F.col("candid").isNotNull())
    return rows.withColumn("isdiffpos", difference_sign(F.col("isdiffpos"))).distinct()


def difference_photometry(df: DataFrame) -> DataFrame:
    """Adds fluxes and magnitudes; each intermediate is computed once."""
    diff, ref = F.col("diff_flux_ujy"), F.col("_ref_flux")
    diff_err, ref_err = F.col("diff_flux_err_ujy"), F.col("_ref_flux_err")
    total, total_err = F.col("total_flux_ujy"), F.col("total_flux_err_ujy")
    return (
        df.withColumns({
            "diff_flux_ujy": ph.flux(F.col("magpsf")),
            "_ref_flux": ph.flux(F.col("magnr")),
        })
        .withColumns({
            "diff_flux_err_ujy": ph.flux_error(F.col("sigmapsf"), diff),
            "_ref_flux_err": ph.flux_error(F.col("sigmagnr"), ref),
            "total_flux_ujy": ph.total_flux(ref, diff, F.col("isdiffpos")),
        })
        .withColumns({
            "total_flux_err_ujy": ph.quadrature(diff_err, ref_err),
            "apparent_mag": ph.magnitude(total),
        })
        .withColumn("apparent_mag_err", ph.magnitude_error(total_err, total))
        .drop("_ref_flux", "_ref_flux_err")
    )


def detection(
    alerts: DataFrame,
    reference_rows: DataFrame,
    per: Sequence[str] = (),
    origin: str | None = None,
) -> DataFrame:
    """Current candidates plus history detections that are not current.

    History rows carry no reference-image id, so they can never match
    ``reference_rows``: only the current rows go through that join. ``origin``
    names an extra column telling whether the row is a current one.
    """
    current = current_detections(alerts, per)
    history = exclude_current(
        history_detections(alerts, per), current, [*per, "candid"]
    )
    matched = match_reference(
        current.distinct(),
        reference_rows,
        keys=[*per, "objectid", "fid", "rfid"],
        values=["magnr", "sigmagnr"],
        gate=F.col("distnr") < F.lit(MATCH_RADIUS),
    )
    if origin:
        matched = matched.withColumn(origin, F.lit(True))
        history = history.withColumn(origin, F.lit(False))
    every = pad_union(matched, history).withColumns({
        "mjd": jd_to_mjd(F.col("jd")), "ts": jd_to_timestamp(F.col("jd")),
    })
    extra = [origin] if origin else []
    return difference_photometry(every).select(*per, *DETECTION_COLUMNS, *extra)


def forced_measurements(alerts: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Usable elements of the forced-photometry histories."""
    rows = explode_fields(
        alerts, "fp_hists", ["procstatus", "jd", *FORCED_FIELDS], [*per, _object_id()]
    )
    return rows.where(
        (F.col("procstatus") == F.lit(GOOD_STATUS))
        & all_measured(*FORCED_MEASURED)
        & all_positive("forcediffimfluxunc")
    ).drop("procstatus")


def best_measurement(rows: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Highest signal-to-noise per exposure; time and flux settle exact ties."""
    return top_row(
        rows.withColumn("snr", ph.signal_to_noise(F.col("forcediffimflux"), F.col("forcediffimfluxunc"))),
        [*per, "objectid", "fid", "pid", "rfid"],
        [F.abs("snr").desc(), F.asc("forcediffimfluxunc"), F.asc("jd"), F.asc("forcediffimflux")],
    )


def forced_photometry_values(df: DataFrame, calibrated_error: bool = False) -> DataFrame:
    """Adds magnitudes and fluxes to forced measurements.

    ``apparent_mag_err`` divides the uncalibrated uncertainty by a calibrated
    flux, as published; ``calibrated_error`` uses the calibrated one.
    """
    counts, unc, zp = F.col("forcediffimflux"), F.col("forcediffimfluxunc"), F.col("magzpsci")
    total = F.col("total_flux_ujy")
    error = F.col("diff_flux_err_ujy") if calibrated_error else unc
    return (
        df.withColumns({
            "snr": ph.signal_to_noise(counts, unc),
            "magpsf": ph.instrument_magnitude(zp, counts),
            "sigmapsf": ph.instrument_magnitude_error(unc, counts),
            "diff_flux_ujy": ph.calibrated_flux(zp, counts),
            "diff_flux_err_ujy": ph.calibrated_flux(zp, unc),
        })
        .withColumn("total_flux_ujy", ph.flux(F.col("magnr")) + F.col("diff_flux_ujy"))
        .withColumns({
            "apparent_mag": ph.magnitude(total),
            "apparent_mag_err": ph.magnitude_error(error, total),
        })
    )


def forced_photometry(
    alerts: DataFrame, per: Sequence[str] = (), calibrated_error: bool = False
) -> DataFrame:
    best = best_measurement(forced_measurements(alerts, per), per)
    values = forced_photometry_values(best, calibrated_error)
    return values.select(
        *per, "objectid", jd_to_mjd(F.col("jd")).alias("mjd"), *FORCED_FIELDS,
        "snr", "magpsf", "sigmapsf", "diff_flux_ujy", "diff_flux_err_ujy", "total_flux_ujy",
        "apparent_mag", "apparent_mag_err", jd_to_timestamp(F.col("jd")).alias("ts"),
    )
