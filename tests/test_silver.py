from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import alert, forced, history

from novalake.plans import silver
from novalake.plans.silver import BATCH

ZP = 3630780547.7010136


def flux(m):
    return ZP * 10 ** (-0.4 * m)


def by(df, key="candid"):
    return {getattr(r, key): r for r in df.collect()}


def test_gaia_needs_all_four_and_positive_distances(alerts):
    good = {"neargaia": 1.0, "neargaiabright": 2.0, "maggaia": 15.0, "maggaiabright": 14.0}
    df = silver.crossmatch_gaia(alerts(
        alert(1, **good), alert(2, **good | {"maggaia": None}), alert(3, **good | {"neargaia": -999.0}),
        alert(4, **good | {"neargaiabright": 0.0}),
    ))
    assert df.columns == ["candid", "objectid", "neargaia", "neargaiabright", "maggaia", "maggaiabright", "ts"]
    assert set(by(df)) == {1}
    assert by(df)[1].ts == dt.datetime(2024, 1, 1, 6)


def test_solar_system(alerts):
    good = {"ssdistnr": 3.0, "ssmagnr": 17.0, "ssnamenr": "ceres"}
    df = silver.crossmatch_ss(alerts(
        alert(1, **good), alert(2, **good | {"ssnamenr": None}), alert(3, **good | {"ssmagnr": -99.0}),
    ))
    assert df.columns == ["candid", "objectid", "ssdistnr", "ssmagnr", "ssnamenr", "ts"]
    assert set(by(df)) == {1}


def test_ps1_duplicate_neighbour_merges_columns(alerts):
    df = silver.crossmatch_ps1(alerts(
        alert(1, nmtchps=3, objectidps1=7, sgmag1=None, srmag1=1.0, objectidps2=7, sgmag2=2.0, srmag2=2.5,
              objectidps3=9, sgmag3=3.0),
        alert(2, nmtchps=0, objectidps1=7, sgmag1=5.0),
        alert(3, nmtchps=None, objectidps1=7),
    ))
    got = {r.objectidps: (r.candid, r.sgmag, r.srmag) for r in df.collect()}
    assert got == {7: (1, 2.0, 1.0), 9: (1, 3.0, None)}
    assert df.columns == ["candid", "objectid", "objectidps", *silver.PS1_FIELDS, "ts"]


def test_non_detections_are_history_without_id(alerts):
    df = silver.non_detection(alerts(
        alert(1, prv=[history(candid=None, diffmaglim=20.5, field=4), history(candid=8)]),
        alert(2, prv=[history(candid=None, diffmaglim=20.5, field=4)]),
        alert(3, prv=[]), alert(4),
    ))
    got = [(r.objectid, r.mjd, r.diffmaglim, r.field) for r in df.collect()]
    assert got == [("A", 60310.25, 20.5, 4)] * 2  # not deduplicated here
    assert df.columns == ["objectid", "mjd", *silver.UPPER_LIMIT_FIELDS, "ts"]


def test_reference_takes_first_value_per_column(alerts):
    df = silver.reference(alerts(
        alert(3, chinr=0.3, sharpnr=3.0), alert(1, chinr=None, sharpnr=1.0), alert(2, chinr=0.2, sharpnr=2.0),
        alert(4, rfid=None), alert(5, rfid=None),
    ))
    got = by(df, "rfid")
    assert len(df.collect()) == 2  # NULL ids form one group
    assert (round(got[11].chinr, 6), got[11].sharpnr, got[11].mjdstartref) == (0.2, 1.0, 59000.0)
    assert got[11].endref_ts == dt.datetime(2020, 12, 17)
    assert df.columns == (
        "objectid fid rfid rcid field magnr sigmagnr chinr sharpnr ranr decnr mjdstartref mjdendref "
        "startref_ts endref_ts nframesref".split()
    )


def detect(df, **options):
    return silver.detection(df, silver.reference(df), **options)


def test_detection_of_a_current_candidate(alerts):
    df = detect(alerts(alert(1)))
    row = by(df)[1]
    assert len(df.columns) == 60  # 61 with the audit column
    assert df.columns == silver.DETECTION_COLUMNS and "jd" not in df.columns
    total = flux(16.0) + flux(17.0)
    errors = [0.4 * math.log(10) * s * flux(m) for s, m in ((0.1, 17.0), (0.2, 16.0))]
    assert row.diff_flux_ujy == pytest.approx(flux(17.0))
    assert row.diff_flux_err_ujy == pytest.approx(errors[0], rel=1e-6)
    assert row.total_flux_ujy == pytest.approx(total)
    assert row.total_flux_err_ujy == pytest.approx(math.hypot(*errors), rel=1e-6)
    assert row.apparent_mag == pytest.approx(-2.5 * math.log10(total / ZP))
    assert row.apparent_mag_err == pytest.approx(2.5 / math.log(10) * math.hypot(*errors) / total, rel=1e-6)


def test_unknown_sign_is_subtracted_and_may_leave_no_magnitude(alerts):
    row = by(detect(alerts(alert(1, isdiffpos=None, magnr=18.0))))[1]
    assert row.total_flux_ujy == pytest.approx(flux(18.0) - flux(17.0))
    assert row.total_flux_ujy < 0 and row.apparent_mag is None and row.apparent_mag_err is None


@pytest.mark.parametrize("distnr, matched", [(1.4, True), (1.5, False), (None, False)])
def test_reference_distance(alerts, distnr, matched):
    row = by(detect(alerts(alert(1, distnr=distnr))))[1]
    assert (row.magnr is not None) == matched == (row.total_flux_ujy is not None)


def test_history_rows(alerts):
    """Copies collapse, current ids are left out, nothing matches a reference."""
    copy = history(candid=50, distnr=0.1, isdiffpos=" T ")
    df = detect(alerts(
        alert(1, prv=[copy, copy, history(candid=None), history(candid=2)]),
        alert(2, prv=[history(candid=50, distnr=0.1, isdiffpos="1")]),  # same row once decoded
        alert(3, prv=[history(candid=50, distnr=0.2)]),
    ))
    rows = [r for r in df.collect() if r.candid == 50]
    assert len(rows) == 2 and len(df.collect()) == 5
    for row in rows:
        assert (row.rfid, row.magnr, row.total_flux_ujy, row.apparent_mag, row.drb) == (None,) * 5
        assert row.diff_flux_ujy == pytest.approx(flux(17.0))


def test_repeated_current_rows_collapse_and_missing_ids_drop(alerts):
    df = detect(alerts(alert(1), alert(1), alert(None), alert(2, jd=None)))
    assert sorted(r.candid for r in df.collect()) == [1, 2]


def test_batches_do_not_see_each_other(alerts):
    """A history row whose own alert came a day earlier is emitted again."""
    df = alerts(alert(1, date="2024-01-01"), alert(2, date="2024-01-02", prv=[history(candid=1)]))
    got = silver.detection(df, silver.reference(df, BATCH), BATCH, origin="cur")
    assert sorted((str(r.observation_date), r.candid, r.cur) for r in got.collect()) == [
        ("2024-01-01", 1, True), ("2024-01-02", 1, False), ("2024-01-02", 2, True),
    ]


@pytest.mark.parametrize("field", silver.FORCED_MEASURED)
@pytest.mark.parametrize("value", [-99999.0, None])
def test_forced_sentinels(alerts, field, value):
    df = silver.forced_photometry(alerts(alert(1, fp=[forced(**{field: value})])))
    assert df.count() == 0


def test_forced_status_and_uncertainty(alerts):
    df = alerts(alert(1, fp=[forced(procstatus="61"), forced(forcediffimfluxunc=0.0), forced(procstatus=None)]))
    assert silver.forced_photometry(df).count() == 0


def test_forced_values(alerts):
    df = silver.forced_photometry(alerts(alert(1, fp=[forced()])))
    r = df.first()
    diff = flux(26.0) * 100
    total = flux(18.0) + diff
    assert (r.snr, r.mjd) == (10.0, 60310.25)
    assert r.magpsf == pytest.approx(26 - 2.5 * 2)
    assert r.sigmapsf == pytest.approx(2.5 / math.log(10) / 10)
    assert (r.diff_flux_ujy, r.diff_flux_err_ujy) == (pytest.approx(diff), pytest.approx(diff / 10))
    assert r.total_flux_ujy == pytest.approx(total)
    assert r.apparent_mag == pytest.approx(-2.5 * math.log10(total / ZP))
    assert r.apparent_mag_err == pytest.approx(2.5 / math.log(10) * 10 / total)  # uncalibrated, as published
    fixed = silver.forced_photometry(alerts(alert(1, fp=[forced()])), calibrated_error=True).first()
    assert fixed.apparent_mag_err == pytest.approx(2.5 / math.log(10) * diff / 10 / total)


def test_forced_zero_flux(alerts):
    r = silver.forced_photometry(alerts(alert(1, fp=[forced(forcediffimflux=0.0)]))).first()
    assert (r.snr, r.magpsf, r.sigmapsf) == (0.0, None, None)


def test_best_measurement(alerts):
    df = silver.forced_photometry(alerts(
        alert(1, fp=[forced(forcediffimflux=50.0), forced(forcediffimflux=-200.0, forcediffimfluxunc=5.0),
                     forced(forcediffimflux=80.0, forcediffimfluxunc=2.0), forced(pid=6), forced(rfid=None)]),
    ))
    got = {(r.pid, r.rfid): r.forcediffimflux for r in df.collect()}
    assert got == {(5, 11): 80.0, (6, 11): 100.0, (5, None): 100.0}  # 40 beats none; tie: smaller unc
