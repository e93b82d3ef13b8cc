from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from novalake.functions import photometry as ph
from novalake.functions.julian import jd_to_mjd, jd_to_timestamp
from novalake.functions.predicates import all_measured, all_positive, all_present, any_null
from novalake.functions.text import (
    base_name,
    blank_separated_fields,
    difference_sign,
    payload_key,
)

ZP = 3630780547.7010136


def one(spark, *cols, **values):
    columns = ", ".join(f"{v} AS {k}" for k, v in values.items()) or "1 AS one"
    return tuple(spark.sql(f"SELECT {columns}").select(*cols).first())


def test_zero_point_is_folded(spark):
    df = spark.range(1).select(ph.zero_point().alias("zp"))
    assert df.first().zp == pytest.approx(ZP, rel=1e-12)
    assert "POWER" not in df._jdf.queryExecution().optimizedPlan().toString().upper()


def test_flux_and_error(spark):
    f, e = one(
        spark, ph.flux(F.col("m")), ph.flux_error(F.col("s"), ph.flux(F.col("m"))),
        m="CAST(16.0 AS FLOAT)", s="0.1D",
    )
    assert f == pytest.approx(ZP * 10 ** -6.4)
    assert e == pytest.approx(0.4 * math.log(10) * 0.1 * f)


@pytest.mark.parametrize("sign, expected", [("true", 7.0), ("false", 3.0), ("CAST(NULL AS BOOLEAN)", 3.0)])
def test_unknown_sign_subtracts(spark, sign, expected):
    assert one(spark, ph.total_flux(F.lit(5.0), F.lit(2.0), F.col("s")), s=sign) == (expected,)


def test_no_reference_means_no_total(spark):
    assert one(spark, ph.total_flux(F.col("r"), F.lit(2.0), F.lit(True)), r="CAST(NULL AS DOUBLE)") == (None,)


@pytest.mark.parametrize("total, has", [("10.0D", True), ("0.0D", False), ("-3.0D", False), ("CAST(NULL AS DOUBLE)", False)])
def test_magnitude_only_of_positive_flux(spark, total, has):
    m, e = one(spark, ph.magnitude(F.col("t")), ph.magnitude_error(F.lit(2.0), F.col("t")), t=total)
    if not has:
        assert (m, e) == (None, None)
    else:
        assert m == pytest.approx(-2.5 * math.log10(10 / ZP))
        assert e == pytest.approx(2.5 / math.log(10) * 0.2)


def test_quadrature(spark):
    assert one(spark, ph.quadrature(F.lit(3.0), F.lit(4.0))) == (5.0,)


def test_instrument_values_of_zero_counts(spark):
    got = one(
        spark, ph.signal_to_noise(F.col("f"), F.lit(2.0)),
        ph.instrument_magnitude(F.lit(26.0), F.col("f")),
        ph.instrument_magnitude_error(F.lit(2.0), F.col("f")), f="0.0D",
    )
    assert got == (0.0, None, None)


def test_zero_uncertainty_is_null_not_an_error(spark):
    assert one(spark, ph.signal_to_noise(F.lit(2.0), F.lit(0.0))) == (None,)


def test_instrument_magnitude_of_negative_counts(spark):
    (m,) = one(spark, ph.instrument_magnitude(F.lit(26.0), F.lit(-100.0)))
    assert m == pytest.approx(21.0)


def test_julian_dates(spark):
    mjd, ts = one(spark, jd_to_mjd(F.col("jd")), jd_to_timestamp(F.col("jd")), jd="2460310.75D")
    assert mjd == 60310.25
    assert ts == dt.datetime(2024, 1, 1, 6)
    assert one(spark, jd_to_timestamp(F.col("jd")), jd="CAST(NULL AS DOUBLE)") == (None,)


def test_day_of_timestamp_is_the_julian_day(spark):
    jds = spark.range(2000).select((F.lit(2460000.5) + F.col("id") * 0.37).alias("jd"))
    wrong = jds.where(
        F.datediff(F.to_date(jd_to_timestamp(F.col("jd"))), F.lit("1970-01-01").cast("date"))
        != F.floor(F.col("jd") - 2440587.5)
    )
    assert wrong.count() == 0


@pytest.mark.parametrize("flag, expected", [
    ("' T '", True), ("'1'", True), ("'f'", False), ("'0'", False), ("'x'", None), ("NULL", None), ("''", None),
])
def test_difference_sign(spark, flag, expected):
    assert one(spark, difference_sign(F.col("s")), s=f"CAST({flag} AS STRING)") == (expected,)


@pytest.mark.parametrize("line", ["", "   ", "a", "  a  b ", "a\tb  c/d.gz", "x y ", "a b", "\x1ca\x1db"])
def test_fields_split_as_python_does(spark, line):
    df = spark.createDataFrame([(line,)], "s string")
    assert df.select(blank_separated_fields(F.col("s"))).first()[0] == line.split()


@pytest.mark.parametrize("path, name", [("a/b/c.gz", "c.gz"), ("c.gz", "c.gz"), ("a/b/", "b"), ("/", "")])
def test_base_name(spark, path, name):
    assert one(spark, base_name(F.col("p")), p=f"'{path}'") == (name,)


@pytest.mark.parametrize("prefix", ["cutouts", "cutouts/"])
def test_payload_key(spark, prefix):
    (key,) = one(spark, payload_key(prefix, F.lit("42"), F.col("t")), t="'cutoutScience'")
    assert key == "cutouts/42/42_science.fits.gz"


def test_predicates(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2.0), (2, NULL), (3, -99999.0), (4, 0.0) t(id, x)")
    ids = lambda c: [r.id for r in df.where(c).orderBy("id").collect()]
    assert ids(all_present("x")) == [1, 3, 4]
    assert ids(all_positive("x")) == [1]
    assert ids(all_measured("x")) == [1, 4]
    assert ids(any_null("id", "x")) == [2]
