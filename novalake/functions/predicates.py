"""Row-quality predicates over lists of columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: "not measured" in forced photometry.
MISSING = -99999


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def all_present(*names: str) -> Column:
    return _all(F.col(n).isNotNull() for n in names)


def all_positive(*names: str) -> Column:
    """Drops non-positive sentinels, and NULL with them."""
    return _all(F.col(n) > 0 for n in names)


def all_measured(*names: str) -> Column:
    return _all(F.col(n).isNotNull() & (F.col(n) != F.lit(MISSING)) for n in names)


def any_null(*names: str) -> Column:
    return reduce(or_, (F.col(n).isNull() for n in names), F.lit(False))
