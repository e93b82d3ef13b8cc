"""SQL for the alert-shaped inputs, flat: the oracle never builds an array."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StructType

from novalake.fixtures import CANDIDATE_SQL, DAY, FORCED_SQL, HISTORY_SQL, LISTED_FORCED_SQL
from novalake.schemas import CANDIDATE, FORCED, HISTORY


def f32(expr: str) -> str:
    """A float32 value, widened again so that arithmetic is done in double."""
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


def _columns(values: dict[str, str], schema: StructType) -> str:
    out = []
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, FloatType):
            sql = f32(values.get(field.name, "0.5::DOUBLE"))
        elif isinstance(kind, DoubleType):
            sql = f"CAST({values.get(field.name, '0.5')} AS DOUBLE)"
        elif isinstance(kind, IntegerType):
            sql = f"CAST({values.get(field.name, '3')} AS INTEGER)"
        elif isinstance(kind, LongType):
            sql = f"CAST({values.get(field.name, '7')} AS BIGINT)"
        else:
            sql = values.get(field.name, "'v1'")
        out.append(f"{sql} AS {field.name}")
    return ",\n  ".join(out)


_HEAD = f"'OBJ' || CAST(c AS VARCHAR) AS objectid, {DAY} AS observation_date, k, c"
_ORDERS = "(SELECT o_orderkey AS k, o_custkey AS c FROM orders)"
_ITEMS = (
    "(SELECT l_orderkey AS k, o_custkey AS c, CAST(l_linenumber AS BIGINT) AS n, "
    "lineitem.* FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)
# The nested variant: every order carries the same short list of elements.
_LISTED = (
    "(SELECT o_orderkey AS k, o_custkey AS c, CAST(unnest([1, 2, 3, 2]) AS BIGINT) AS n FROM orders)"
)

A = f"a AS (SELECT {_HEAD},\n  {_columns(CANDIDATE_SQL, CANDIDATE)}\n  FROM {_ORDERS} o)"
H = f"h AS (SELECT {_HEAD}, n,\n  {_columns(HISTORY_SQL, HISTORY)}\n  FROM {_ITEMS} i)"
H_LISTED = f"h AS (SELECT {_HEAD}, n,\n  {_columns(HISTORY_SQL, HISTORY)}\n  FROM {_LISTED} i)"
FP = f"fp AS (SELECT {_HEAD}, n,\n  {_columns(FORCED_SQL, FORCED)}\n  FROM {_ITEMS} i)"

# One forced measurement for each order, as in the listed alerts.
FP_LISTED = (f"fp AS (SELECT {_HEAD},\n  {_columns(LISTED_FORCED_SQL, FORCED)}\n"
             "  FROM (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS price FROM orders) o)")


def seconds(jd: str) -> str:
    """Whole epoch seconds of a Julian date."""
    return f"CAST(round(({jd} - 2440587.5::DOUBLE) * 86400::DOUBLE) AS BIGINT)"


def mjd(jd: str) -> str:
    return f"round({jd} - 2400000.5::DOUBLE, 6)"


def r6(expr: str) -> str:
    return f"round({expr}, 6)"
