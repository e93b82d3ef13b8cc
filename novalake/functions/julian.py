"""Julian dates to MJD, timestamps and days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JD of the MJD origin, JD of 1970-01-01T00:00Z, seconds per day.
MJD_ORIGIN_JD = 2400000.5
UNIX_EPOCH_JD = 2440587.5
SECONDS_PER_DAY = 86400.0


def jd_to_mjd(jd: Column) -> Column:
    return jd - F.lit(MJD_ORIGIN_JD)


def jd_to_timestamp(jd: Column) -> Column:
    return F.timestamp_seconds((jd - F.lit(UNIX_EPOCH_JD)) * F.lit(SECONDS_PER_DAY))
