from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from novalake.operators.combine import exclude_current, match_reference, merge_upsert
from novalake.operators.dedupe import dedupe_by_key, first_non_null, latest_per_key, top_row
from novalake.operators.reshape import (
    drop_prefixed,
    explode_fields,
    pad_union,
    stack_branches,
    unpivot_groups,
    with_audit,
)


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("fields", [["a"], ["a", "b", "c"]])  # zipped / exploded
def test_explode_drops_null_and_empty_arrays(spark, fields):
    df = spark.createDataFrame(
        [("x", [(1, 2, 3), (4, None, 6)]), ("y", []), ("z", None)],
        "id string, arr array<struct<a:int,b:int,c:int>>",
    )
    got = rows(explode_fields(df, "arr", fields, ["id"]))
    want = [("x", 1, 2, 3), ("x", 4, None, 6)]
    assert got == [w[: 1 + len(fields)] for w in want]


@pytest.mark.parametrize("fields", [["a"], ["a", "b", "c"]])
def test_explode_keeps_a_null_element(spark, fields):
    df = spark.createDataFrame([("x", [None])], "id string, arr array<struct<a:int,b:int,c:int>>")
    assert rows(explode_fields(df, "arr", fields, ["id"])) == [("x", *[None] * len(fields))]


def test_unpivot_equals_union_of_branches(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 10, 'a', NULL, 'b'), (2, NULL, 'c', 30, NULL) t(id, k1, v1, k2, v2)")
    groups = [{"k": "k1", "v": "v1"}, {"k": "k2", "v": "v2"}]
    got = unpivot_groups(df, groups, "k", ["id"], position="no")
    branches = stack_branches([
        df.select("id", F.lit(i).alias("no"), f"k{i}", f"v{i}").where(f"k{i} IS NOT NULL") for i in (1, 2)
    ])
    assert rows(got) == rows(branches) == [(1, 1, 10, "a"), (2, 2, 30, None)]
    non_null = df.select((F.count("k1") + F.count("k2")).alias("n")).first().n
    assert got.count() == non_null


def test_pad_union_takes_the_other_type(spark):
    left = spark.sql("SELECT 1 AS id, CAST(2 AS FLOAT) AS x, 'v' AS s")
    got = pad_union(left, spark.sql("SELECT 2 AS id"))
    assert got.schema == left.schema or [f.dataType for f in got.schema] == [f.dataType for f in left.schema]
    assert rows(got) == [(1, 2.0, "v"), (2, None, None)]


def test_drop_prefixed(spark):
    df = spark.sql("SELECT 1 AS candid, 2 AS cutoutScience, 3 AS cutoutX, 4 AS myCutout")
    assert drop_prefixed(df).columns == ["candid", "myCutout"]


def test_audit_column_is_last(spark):
    assert with_audit(spark.range(1)).columns == ["id", "_created_ts"]


def test_first_non_null_is_per_column(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('k', 3, 30, 'c'), ('k', 1, NULL, 'a'), ('k', 2, 20, NULL), (NULL, 1, NULL, NULL), (NULL, 2, 5, NULL)
        t(key, ord, x, s)""")
    got = rows(first_non_null(df, ["key"], ["x", "s"], F.col("ord")))
    assert got == [("k", 20, "a"), (None, 5, None)]


def test_top_row_tie(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 5.0, 2), ('a', 5.0, 1), ('b', 1.0, 9) t(k, snr, unc)")
    got = rows(top_row(df, ["k"], [F.desc("snr"), F.asc("unc")]))
    assert [(r[0], r[2]) for r in got] == [("a", 1), ("b", 9)]


def test_dedupe_by_key_prefers_latest_and_is_deterministic(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 'old', 1), (1, 'new', 2), (1, 'newer', 2), (2, 'x', 1),
        (NULL, 'n', 1), (NULL, 'n', 1) t(id, v, day)""")
    want = [(1, "newer", 2), (2, "x", 1), (None, "n", 1), (None, "n", 1)]
    assert rows(dedupe_by_key(df, ["id"], ["day"])) == sorted(want, key=str)
    assert rows(dedupe_by_key(df.orderBy(F.rand(3)), ["id"], ["day"])) == sorted(want, key=str)
    assert rows(dedupe_by_key(df, ["id"], ["day"], null_safe=True)) == sorted(want[:-1], key=str)


def test_latest_per_key(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DATE '2024-01-02', 'b'), (1, DATE '2024-01-01', 'z') t(id, observation_date, v)")
    assert [r.v for r in latest_per_key(df, ["id"]).collect()] == ["b"]


def test_exclude_current_is_disjoint(spark):
    history = spark.range(10).withColumn("v", F.lit(1))
    current = spark.range(0, 20, 2)
    left = exclude_current(history, current, ["id"])
    assert sorted(r.id for r in left.collect()) == [1, 3, 5, 7, 9]
    assert left.join(current, "id").count() == 0


def test_reference_gate_never_drops_rows(spark):
    """A float32 1.4 lies below the threshold 1.4; 1.5 and NULL do not match."""
    left = spark.sql("""SELECT id, 'o' AS objectid, 1 AS fid, rfid, CAST(d AS FLOAT) AS distnr
        FROM VALUES (1, 7, 1.4), (2, 7, 1.5), (3, 7, NULL), (4, NULL, 0.1) t(id, rfid, d)""")
    ref = spark.sql("SELECT 'o' AS objectid, 1 AS fid, 7 AS rfid, 15.0D AS magnr, 0.1D AS sigmagnr")
    got = match_reference(left, ref, ["objectid", "fid", "rfid"], ["magnr", "sigmagnr"], F.col("distnr") < F.lit(1.4))
    assert {r.id: r.magnr for r in got.collect()} == {1: 15.0, 2: None, 3: None, 4: None}


def test_merge_upsert(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (NULL, 'n') t(id, v)")
    source = spark.sql("SELECT * FROM VALUES (2, 'B'), (3, 'C'), (NULL, 'N') t(id, v)")
    once = merge_upsert(target, source, ["id"])
    assert rows(once) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=str)
    assert rows(merge_upsert(once, source, ["id"])) == sorted(rows(once) + [(None, "N")], key=str)
    safe = merge_upsert(target, source, ["id"], null_safe=True)
    assert rows(safe) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "N")], key=str)
    assert rows(merge_upsert(safe, source, ["id"], null_safe=True)) == rows(safe)


def test_merge_adds_columns(spark):
    target = spark.sql("SELECT 1 AS id, 'a' AS v")
    source = spark.sql("SELECT 2 AS id, 'b' AS v, 9 AS extra")
    assert rows(merge_upsert(target, source, ["id"])) == [(1, "a", None), (2, "b", 9)]


def test_top_row_sorts_by_long_keys_first(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, 5L, 1.0D), ('a', 1, 5L, 2.0D), ('b', 1, 5L, 3.0D), ('a', 1, NULL, 4.0D) t(o, f, id, v)")
    best = top_row(df, ["o", "f", "id"], [F.desc("v")])
    assert best.columns == ["o", "f", "id", "v"]
    assert rows(best) == sorted([("a", 1, 5, 2.0), ("b", 1, 5, 3.0), ("a", 1, None, 4.0)], key=str)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"windowspecdefinition\(id#\d+L, o#\d+, f#\d+", plan)
