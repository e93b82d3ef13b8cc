"""Nearest neighbours and sharding, against brute force."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from llm.conftest import AWKWARD
from novalake.llm import posting_lists, sharding
from novalake.llm.queries import op6_posting_lists, op7_sharding

SF = "/root/testdata/sf0.01"


def ranked(rows, asks, count):
    """(query, rank) -> score, by brute force."""
    out = {}
    for query, vector in rows:
        if asks(query):
            scores = sorted(((-float(np.dot(vector, other)), i) for i, other in rows if i != query))
            out[query] = [(i, -s) for s, i in scores[:count]]
    return out


def test_query_finds_the_nearest(spark):
    table = pd.read_parquet(f"{SF}/embeddings.parquet")
    rows = [(int(i), np.array(v, np.float32).astype(float)) for i, v in zip(table["vec_id"], table["embedding"])]
    expected = ranked(rows, lambda i: i % 20 == 0, 20)
    got = op6_posting_lists(spark, SF).toPandas().sort_values(["query_id", "rank"])
    vectors, hits = dict(rows), 0
    for query, part in got.groupby("query_id"):
        assert part["rank"].tolist() == list(range(1, 21)) and query not in part["vec_id"].tolist()
        exact = [float(vectors[query] @ vectors[i]) for i in part["vec_id"]]
        assert np.allclose(part["score"], exact, rtol=1e-12)
        assert part["score"].is_monotonic_decreasing
        hits += len(set(part["vec_id"]) & {i for i, _ in expected[query]})
    assert set(got["query_id"]) == set(expected)
    assert hits / (20 * len(expected)) >= 0.9


def test_recall_on_clustered_vectors_with_a_hot_one(spark):
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(30, 16)) * 3
    vectors = centers[draw.integers(0, 30, 4000)] + draw.normal(size=(4000, 16))
    vectors[::3] = vectors[0]  # a third of the rows are one vector
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    got = posting_lists.nearest(df, F.col("vec_id") % 97 == 0, 10).toPandas()
    plain = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    expected = ranked(plain, lambda i: i % 97 == 0, 10)
    hits = 0
    for query, part in got.sort_values("rank").groupby("query_id"):
        best = {round(s, 4) for _, s in expected[query]}
        hits += sum(round(s, 4) in best for s in part["score"])
        assert len(part) == 10
        if query % 3 == 0:  # ties to the smaller id
            same = [i for i in part["vec_id"] if i % 3 == 0]
            assert same == sorted(same)
    assert hits / (10 * len(expected)) >= 0.9


@pytest.mark.parametrize("varied", [False, True])
def test_two_thousand_lists(spark, monkeypatch, varied):
    """Many small lists, vectors of one length or of very different ones, and queries that equal a centroid."""
    monkeypatch.setattr(posting_lists, "LISTS_SHARE", 200.0)
    made = []
    of = posting_lists.balanced_centroids
    monkeypatch.setattr(posting_lists, "balanced_centroids", lambda x, n: made.append(of(x, n)) or made[-1])
    draw = np.random.default_rng(5)
    x = draw.normal(size=(200, 16))[draw.integers(0, 200, 20_000)] + 0.4 * draw.normal(size=(20_000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if varied:
        x *= np.exp(draw.normal(size=(20_000, 1)))
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>").repartition(4)
    got = posting_lists.nearest(df, F.col("vec_id") % 100 == 0, 20).toPandas()
    assert len(made[0]) >= 1_900
    assert (got.groupby("query_id").size() == 20).all() and got["query_id"].nunique() == 200
    full = x.astype(np.float64)
    hits = 0
    for query, part in got.groupby("query_id"):
        scores = full @ full[query]
        scores[query] = -np.inf
        hits += len(set(np.argsort(-scores)[:20]) & set(part["vec_id"]))
    assert hits / (20 * 200) >= 0.9


def test_no_centroid_is_dropped_and_all_lists_are_taken_for_an_infinite_ratio():
    draw = np.random.default_rng(1)
    points = draw.normal(size=(3_000, 4)).astype(np.float32)
    centers = posting_lists.balanced_centroids(points, 500)
    assert len(centers) >= 500
    graph = posting_lists.CentroidGraph.of(centers, float(np.linalg.norm(centers, axis=1).max()))
    row, found = graph.lists(centers[:3, :3], len(centers), float("inf"), asks=True)
    assert np.bincount(row).tolist() == [len(centers)] * 3


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [-1.0, 0.25]), (9, []),
            (40, [5.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, members string")
    got = posting_lists.nearest(df, F.col("vec_id") % 20 == 0, 3).collect()
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got}
    usable = [(i, np.array(v)) for i, v in rows if i in (0, 1, 2, 20, 40)]
    for query, best in ranked(usable, lambda i: i % 20 == 0, 3).items():
        assert [found[query, n + 1] for n in range(3)] == best
    assert len(found) == 9
    assert posting_lists.nearest(df.limit(0), F.col("vec_id") % 20 == 0, 3).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert posting_lists.nearest(alone, F.lit(True), 3).count() == 0


def test_walk_meets_all_centroids_when_wide_enough():
    draw = np.random.default_rng(1)
    centers = draw.normal(size=(300, 8)).astype(np.float32)
    graph = posting_lists.CentroidGraph.of(centers, 10.0)
    points = draw.normal(size=(20, 8)).astype(np.float32)
    at, apart = graph.walk(points, 300)
    assert (np.sort(at, axis=1) == np.arange(300)).all() and (np.diff(apart, axis=1) >= 0).all()
    few, _ = graph.walk(points, 12)
    assert np.mean([len(set(few[n]) & set(at[n][:12])) for n in range(20)]) > 10


def test_lists_are_balanced():
    draw = np.random.default_rng(2)
    x = np.concatenate([draw.normal(size=(3000, 4)) * 0.1, draw.normal(size=(300, 4)) * 5]).astype(np.float32)
    centers = posting_lists.balanced_centroids(x, 33)
    label = np.argmin((centers**2).sum(1) - 2 * x @ centers.T, axis=1)
    assert np.bincount(label).max() <= 5 * len(x) / 33


def check_shards(got, rows, shards):
    assert len(got) == len(rows)
    sizes = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    ids = [None if pd.isna(i) else int(i) for i in got["doc_id"].astype("Int64")]
    assert Counter(zip(ids, got["size"], got["text_crc32"])) == sizes
    for shard, part in got.groupby("shard"):
        assert 0 <= shard < shards
        assert sorted(part["slot"]) == list(range(len(part)))
    total, largest = got["size"].sum(), got["size"].max()
    held = got.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    assert (held - total / shards).abs().max() <= largest + 0.001 * total


def test_documents_are_sharded(spark):
    docs = pd.read_parquet("/root/testdata/sf0.1/documents.parquet")
    got = op7_sharding(spark, "/root/testdata/sf0.1").toPandas()
    assert set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()
    check_shards(got, list(zip(docs["doc_id"], docs["text"])), 24)
    held = got.groupby("shard")["size"].sum()
    assert held.max() / held.mean() < 1.05
    assert got.groupby("text_crc32")["shard"].nunique().gt(1).sum() <= 23  # copies stay together but at cuts


@pytest.mark.parametrize("pieces", [1, 4])
def test_hot_group_is_cut(make_docs, monkeypatch, pieces):
    monkeypatch.setattr(sharding, "ROWS_PER_PIECE", 3000 // (8 * pieces))
    rows = [(i % 7, "the same text") for i in range(2000)] + [(i, f"t{i}") for i in range(900)] + [(1, "x")] * 100
    got = sharding.shard(make_docs(rows), 8).toPandas()
    check_shards(got, rows, 8)
    assert got[got["text_crc32"] == zlib.crc32(b"the same text")]["shard"].nunique() >= 5


def test_awkward_documents_are_sharded(awkward, make_docs):
    check_shards(sharding.shard(awkward, 5).toPandas(), [r[:2] for r in AWKWARD], 5)
    assert sharding.shard(make_docs([]), 5).count() == 0


def test_sharding_runs_no_python(awkward):
    dealt = sharding.shard(awkward, 5)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_keys_put_equal_texts_side_by_side(spark):
    df = spark.range(50).selectExpr("id", "concat('t', id % 5) as text")
    keys = df.select("text", sharding.key_of(F.col("text"), F.col("id")).alias("key")).orderBy("key").collect()
    changes = sum(a.text != b.text for a, b in zip(keys, keys[1:]))
    assert changes == 4 and min(k.key for k in keys) >= 0 and math.log2(max(k.key for k in keys)) < 63
