"""Anti-join against the current batch, reference match, keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from novalake.operators.reshape import pad_union


def match_keys(
    rows: DataFrame, source: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False
) -> DataFrame:
    """``left_semi`` / ``left_anti`` of ``rows`` with the keys of ``source``.

    The keys go into the join as they are. A distinct before it would change
    nothing in the result, and would take the place under the join where
    adaptive execution needs a plain shuffle to split a hot key of ``rows``.
    """
    ids = source.select(*(F.col(k).alias(f"_src_{k}") for k in keys))
    pairs = [(F.col(k), F.col(f"_src_{k}")) for k in keys]
    match = reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))
    return rows.join(ids, match, how)


def exclude_current(history: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History rows whose key is not among the current ones (none of them NULL)."""
    return match_keys(history, current, keys, "left_anti")


def match_reference(
    rows: DataFrame, reference: DataFrame, keys: Sequence[str], values: Sequence[str], gate: Column
) -> DataFrame:
    """LEFT JOIN on ``keys``; a row that fails ``gate`` stays, unmatched.

    Give ``reference`` as a table rather than as an aggregate: with a plain
    shuffle on both sides a hot object is split at run time.
    """
    renamed = reference.select(
        *(F.col(k).alias(f"_ref_{k}") for k in keys), *values
    )
    equal = reduce(and_, (F.col(k) == F.col(f"_ref_{k}") for k in keys))
    return rows.join(renamed, equal & gate, "left").drop(*(f"_ref_{k}" for k in keys))


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Matched keys take the source row, new keys are added, others stay.

    With plain equality a NULL key matches nothing: such source rows are added
    at every run, and such target rows always stay.
    """
    return pad_union(match_keys(target, source, keys, "left_anti", null_safe), source)
