"""Exact top-k search against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from novalake.llm import top_scores
from novalake.llm.top_scores import LONGEST
from novalake.llm.top_scores import top_scores as search


def brute(rows, count, asks=lambda i: i is not None and i % 20 == 0):
    """A sorted list of (query, rank, id, score); rows are told apart by their place in the list."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (query, q) in enumerate(kept):
        if not asks(query):
            continue
        scores = []
        for m, (other, v) in enumerate(kept):
            if m != n:
                score = max(-LONGEST, min(LONGEST, sum(a * b for a, b in zip(q, v))))
                scores.append((-score, other is None, other, score))
        scores.sort(key=lambda s: (s[0], s[1], s[2] if s[2] is not None else 0))
        out += [(query, rank, s[2], s[3]) for rank, s in enumerate(scores[:count], 1)]
    return sorted(out, key=repr)


def found(spark, rows, count, partitions=3, kind="double"):
    full = [(i, v, "x", "y", 1.5, 7) for i, v in rows]
    df = spark.createDataFrame(
        full, f"vec_id bigint, embedding array<{kind}>, slab string, query string, place double, n int")
    got = search(df.repartition(partitions) if rows else df, F.col("vec_id") % 20 == 0, count).collect()
    return sorted(map(tuple, got), key=repr)


def test_ties_hot_vectors_and_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(top_scores, "SLAB_FLOATS", 256)
    monkeypatch.setattr(top_scores, "QUERY_FLOATS", 64)
    monkeypatch.setattr(top_scores, "CHUNK_ROWS", 16)
    monkeypatch.setattr(top_scores, "CHUNK_QUERIES", 4)
    draw = random.Random(4)
    hot = [0.5, -0.25, 1.0, 0.125]
    rows = [(i, hot if i % 3 == 0 else [draw.choice([-1.0, -0.5, 0.015, 0.5, 1.0]) for _ in range(4)]) for i in range(400)]
    assert found(spark, rows, 7) == brute(rows, 7)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]),
            (1, [1.0]), (2, []), (None, [1.0, 2.0]), (None, [3.0, 1.0]), (7, [0.1, -0.1]), (120, [1e300, 1.0]),
            (140, [-1e300, 1e10]), (3, [2.0**60, 1.0]), (160, [1.0, 2.0, 3.0]), (-20, [-0.001, 0.001])]
    assert found(spark, rows, 5) == brute(rows, 5)
    assert found(spark, rows, 50) == brute(rows, 50)


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(20, [1.0, 0.5]), (20, [1.0, 0.5]), (20, [0.25, 1.0]), (5, [1.0, 1.0]), (5, [1.0, 1.0])]
    assert found(spark, rows, 3) == brute(rows, 3)


@pytest.mark.parametrize("rows", [[], [(20, [1.0])], [(1, [1.0]), (2, [2.0])], [(20, None), (40, [])]])
def test_empty_and_single(spark, rows):
    assert found(spark, rows, 4) == []


def test_many_digits(spark, monkeypatch):
    monkeypatch.setattr(top_scores, "DIGIT_BITS", 3)
    draw = random.Random(9)
    rows = [(i, [draw.gauss(0, 3) for _ in range(9)]) for i in range(200)]
    assert found(spark, rows, 20, kind="double") == brute(rows, 20)
