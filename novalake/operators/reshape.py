"""Exploding record arrays, unpivoting numbered columns, stacking branches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT = "_created_ts"


def explode_fields(
    df: DataFrame, array: str, fields: Sequence[str], keep: Sequence[Column | str] = ()
) -> DataFrame:
    """One row per array element, with the named element fields as columns.

    A NULL or empty array gives no row. For a few fields of a wide element the
    field arrays are zipped: the scan then skips the other fields, also when a
    filter on an element field follows. For most fields the struct itself is
    exploded, which builds fewer objects per row.
    """
    element = df.schema[array].dataType.elementType
    if 2 * len(fields) <= len(element):
        zipped = F.arrays_zip(*(F.col(f"{array}.{f}").alias(f) for f in fields))
        return df.select(*keep, F.inline(zipped).alias(*fields))
    exploded = df.select(*keep, F.explode(array).alias("_element"))
    kept = [c for c in exploded.columns if c != "_element"]
    return exploded.select(*kept, *(f"_element.{f}" for f in fields))


def unpivot_groups(
    df: DataFrame,
    groups: Sequence[Mapping[str, str | Column]],
    required: str,
    keep: Sequence[Column | str] = (),
    position: str | None = None,
) -> DataFrame:
    """Numbered column groups to rows, in one scan.

    Each group maps an output name to its source column. Groups whose
    ``required`` column is NULL are dropped; ``position`` adds the 1-based
    group number.
    """
    names = list(groups[0])
    structs = []
    for number, group in enumerate(groups, start=1):
        cols = [F.lit(number).alias(position)] if position else []
        cols += [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in group.items()]
        structs.append(F.struct(*cols))
    out = ([position] if position else []) + names
    return df.select(*keep, F.inline(F.array(*structs)).alias(*out)).where(
        F.col(required).isNotNull()
    )


def stack_branches(branches: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position."""
    return reduce(DataFrame.unionAll, branches)


def pad_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION ALL by name; a column one side lacks is NULL, typed by the other."""
    return left.unionByName(right, allowMissingColumns=True)


def drop_prefixed(df: DataFrame, prefix: str = "cutout") -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith(prefix)))


def with_audit(df: DataFrame, column: str = AUDIT, at: dt.datetime | None = None) -> DataFrame:
    """Adds the time of the write, or the one given."""
    return df.select("*", (F.lit(at) if at else F.current_timestamp()).alias(column))
