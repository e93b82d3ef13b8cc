"""One row per key: per-column first value, best row, latest row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from novalake.functions.predicates import any_null


def first_non_null(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Column
) -> DataFrame:
    """Per key and per column: the non-null value that comes first in ``order``.

    Columns are picked independently, so a row may mix several inputs. NULL
    keys form one group. Partial aggregation keeps a hot key at one row per
    input split before anything is shuffled.
    """
    picked = [
        F.min_by(F.col(v), F.when(F.col(v).isNotNull(), order)).alias(v) for v in values
    ]
    return df.groupBy(*keys).agg(*picked)


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Catalyst turns the rank filter into a group limit before the shuffle, so a
    hot key sends one row per input split to its reducer. Both sort by the keys:
    long ones go first, since they settle most comparisons without a look at the row.
    """
    keys = sorted(keys, key=lambda k: not isinstance(df.schema[k].dataType, LongType))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedupe_by_key(
    df: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """At most one row per key, ready for an upsert.

    The row with the greatest ``latest`` columns wins; the other columns break
    ties, so the result does not depend on the input order. Without
    ``null_safe`` a NULL key equals nothing, hence such rows all stay.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest]
    order = [F.col(c).desc_nulls_last() for c in [*latest, *rest]] or [F.lit(1)]
    if null_safe:
        return top_row(df, keys, order)
    # A row without key is a group of its own, so that one pass serves all rows.
    alone = F.when(any_null(*keys), F.monotonically_increasing_id())
    return top_row(df.withColumn("_alone", alone), [*keys, "_alone"], order).drop("_alone")


def latest_per_key(df: DataFrame, keys: Sequence[str], latest: str = "observation_date") -> DataFrame:
    """State after applying the batches in ``latest`` order, in one job."""
    return dedupe_by_key(df, keys, [latest])
