"""Result columns in a form two engines can agree on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType, TimestampType


def comparable(df: DataFrame, exact: Sequence[str] = ("snr",)) -> DataFrame:
    """Floats rounded to 6 digits, timestamps as whole epoch seconds.

    ``pow`` and ``log10`` differ in the last bit between math libraries, and
    sub-microsecond parts of a Julian date are cut or rounded. Plain divisions
    (``exact``) agree as they are.
    """
    cols = []
    for field in df.schema.fields:
        name = field.name
        if name in exact:
            cols.append(name)
        elif isinstance(field.dataType, (FloatType, DoubleType)):
            cols.append(f"round(CAST({name} AS DOUBLE), 6) AS {name}")
        elif isinstance(field.dataType, TimestampType):
            cols.append(f"CAST(round(unix_micros({name}) / 1e6D) AS BIGINT) AS {name}")
        else:
            cols.append(name)
    return df.selectExpr(*cols)
