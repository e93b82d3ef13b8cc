"""Jaccard join, components, decontamination: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.conftest import AWKWARD, EXTRA
from novalake.llm import common, decontamination, jaccard_join
from novalake.llm.components import components
from novalake.llm.fm_index import FMIndex, suffix_array
from novalake.llm.queries import op5_decontamination, op9_jaccard_join

SF = "/root/testdata/sf0.001"


def find_root(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def joined(texts):
    """Set sizes and, for each text, a representative of its component."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    holders, parent = defaultdict(list), list(range(len(sets)))
    for i, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                parent[find_root(parent, i)] = find_root(parent, j)
    return [len(s) for s in sets], [find_root(parent, i) for i in range(len(sets))]


def check_join(got, ids, texts):
    sizes, roots = joined(texts)
    least = {}
    for i, root in zip(ids, roots):
        least[root] = min(least.get(root, i), i)
    expected = {i: (n, least[r]) for i, n, r in zip(ids, sizes, roots)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == expected
    assert len(got) == len(ids)


def test_join_of_near_copies(make_docs, near_copies):
    texts = near_copies + ["", None, "A a", "a A"]
    got = jaccard_join.join(make_docs(list(enumerate(texts)))).toPandas()
    check_join(got, range(len(texts)), texts)


def test_join_when_sets_are_spread_out(make_docs, near_copies, monkeypatch):
    """Without slack many sets have more empty segments than allowed; candidates are still complete."""
    texts = near_copies

    def entries(slack):
        cuts = jaccard_join.Cuts(jaccard_join.band_edges(3000))
        for band in range(30):
            cut = cuts[band]
            cut.slack, cut.segments = slack, cut.difference + 1 + slack
        return jaccard_join.index_entries(sets, cuts)

    sets = [s for s in map(jaccard_join.shingles, texts) if len(s)]
    for slack in (0, 1, 3):
        keys, owners, _, _ = entries(slack)
        sharing = defaultdict(set)
        for k, o in zip(keys.tolist(), owners.tolist()):
            sharing[k].add(o)
        pairs = {(a, b) for g in sharing.values() for a in g for b in g if a < b}
        for a in range(len(sets)):
            for b in range(a + 1, len(sets)):
                if jaccard_join.linked(sets[a], sets[b]) and not np.array_equal(sets[a], sets[b]):
                    assert (a, b) in pairs


def test_chain_that_no_single_member_links(make_docs):
    """Neighbours in the chain link, others do not: all pairs across components must be looked at."""
    words = [f"v{i}" for i in range(400)]
    texts = [" ".join(words[6 * i : 6 * i + 90]) for i in range(12)]
    got = jaccard_join.join(make_docs(list(enumerate(texts)))).toPandas()
    check_join(got, range(len(texts)), texts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=150, unique=True),
       st.lists(st.integers(0, 400), min_size=1, max_size=150, unique=True))
def test_sketch_never_excludes_a_link(a, b):
    x, y = (np.sort(jaccard_join.mix(np.array(v, np.uint64))) for v in (a, b))
    y = np.union1d(x[: len(x) * 9 // 10], y[: max(1, len(x) // 10)])
    if jaccard_join.linked(x, y):
        assert jaccard_join.possible([len(x)], [len(y)], [jaccard_join.sketch(x)], [jaccard_join.sketch(y)])[0]


def test_join_of_awkward_rows(awkward, make_docs):
    got = jaccard_join.join(awkward).toPandas()
    assert len(got) == len(AWKWARD)
    by_text = dict(zip(got["doc_id"].astype("Int64").astype(str), zip(got["n_shingles"], got["component_id"])))
    assert by_text["8"] == (0, 8) and by_text["9"] == (0, 9) and by_text["-3"] == (1, -3)
    assert jaccard_join.join(make_docs([])).count() == 0


def test_one_of_each_group_stays(make_docs, near_copies):
    rows = [(100 - i, t) for i, t in enumerate(near_copies[:60])] + [(3, ""), (None, None), (500, near_copies[0])]
    docs = make_docs(rows)
    got = jaccard_join.keep_one(docs)
    assert got.columns == docs.columns and got.first()[EXTRA[0]] == EXTRA[0]
    _, roots = joined([r[1] for r in rows])
    least = {}
    for (i, text), root in zip(rows, roots):
        least[root] = min(least.get(root, (True, 10**9)), (i is None, i or 0))
    kept = Counter(r.doc_id for r in got.select("doc_id").collect())
    assert kept == Counter(None if none else i for none, i in least.values())


def test_repeated_ids_and_empty_tables_in_keep_one(awkward, make_docs):
    kept = jaccard_join.keep_one(awkward).toPandas()
    assert Counter(kept["text"].fillna("-"))["The quick brown fox, jumps over the lazy dog. It's 42!"] == 1
    assert len(kept) == len(AWKWARD) - 1
    assert jaccard_join.keep_one(make_docs([])).count() == 0


def test_keep_one_when_scans_cut_the_files_in_other_ways(spark, make_docs, near_copies, monkeypatch):
    """The split size follows the cores there are at each scan; here it changes between two steps."""
    rows = [(i, t) for i, t in enumerate(near_copies)]
    docs = make_docs(rows, 6)
    key = "spark.sql.files.maxPartitionBytes"
    before, join = spark.conf.get(key), jaccard_join._join

    def join_then_cut_finer(*args):
        out = jaccard_join.staged(join(*args), "test-joined")
        spark.conf.set(key, "2000")
        return out

    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    monkeypatch.setattr(jaccard_join, "_join", join_then_cut_finer)
    try:
        kept = [r.doc_id for r in jaccard_join.keep_one(docs).select("doc_id").collect()]
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    _, roots = joined([r[1] for r in rows])
    assert sorted(kept) == sorted({root: i for (i, _), root in reversed(list(zip(rows, roots)))}.values())


def test_components_of_a_long_path_and_a_star(spark):
    draw = random.Random(4)
    path = list(range(60))
    draw.shuffle(path)
    edges = list(zip(path, path[1:])) + [(1000, i) for i in range(1001, 1300)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert all(got[i] == 0 for i in path)
    assert all(got[i] == 1000 for i in range(1000, 1300))


def test_join_query(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    check_join(op9_jaccard_join(spark, SF).toPandas(), docs["doc_id"].tolist(), docs["text"].tolist())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=80), st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_fm_index_finds_every_place(symbols, pattern):
    text = np.array([*symbols, 0])
    assert [tuple(text[i:]) for i in suffix_array(text)] == sorted(tuple(text[i:]) for i in range(len(text)))
    index = FMIndex(text, 5)
    which, low, high = index.ranges(np.array([pattern]))
    places = index.locate(np.concatenate([np.arange(a, b) for a, b in zip(low, high)])) if len(which) else []
    m = len(pattern)
    assert sorted(places) == [i for i in range(len(symbols) - m + 1) if symbols[i : i + m] == pattern]


WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])] |= {item} - {None}
    out = []
    for text in texts:
        w, found = words(text), set()
        hit = np.zeros(len(w), bool)
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit[i : i + size] = True
                    found |= windows[tuple(w[i : i + size])]
        n = int(hit.sum())
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((len(w), n, len(found), digest, n > 0 and 20 * n >= len(w)))
    return out


def test_decontamination_query(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    got = op5_decontamination(spark, SF).toPandas().sort_values("doc_id")
    rows = list(zip(got["n_words"], got["n_hit"], got["n_items"], got["items_sha256"], got["contaminated"]))
    assert rows == contamination(docs["text"], zip(items["item_id"], items["text"]))


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_awkward_benchmark(spark, make_docs, block_bytes):
    long = " ".join(f"x{i}" for i in range(30))
    items = [(1, "fox jumps"), (1, "fox jumps"), (None, "lazy dog"), (2, long), (3, None), (4, " "), (5, "a a a"), (12, "42")]
    texts = [r[1] for r in AWKWARD] + [long.upper(), long + " y " + long, "a a a a a", "x3 " * 5]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = make_docs([(i, t) for i, t in enumerate(texts)])
    got = decontamination.annotate(docs, benchmark, "spans_", block_bytes=block_bytes).toPandas().sort_values("doc_id")
    assert list(got.columns) == [*docs.columns, "spans_"]
    rows = [(f["n_words"], sum(b - a for a, b in zip(f["starts"], f["ends"])), sorted(f["items"])) for f in got["spans_"]]
    expected = contamination(texts, [i for i in items if i[1]])
    assert [r[:2] for r in rows] == [e[:2] for e in expected]
    assert [hashlib.sha256(",".join(r[2]).encode()).hexdigest() for r in rows] == [e[3] for e in expected]
    kept = decontamination.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, e in enumerate(expected) if not e[4]]


def test_empty_benchmark_and_documents(spark, make_docs, awkward):
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.drop_contaminated(awkward, nothing).count() == len(AWKWARD)
    assert decontamination.drop_contaminated(make_docs([]), nothing).count() == 0


def test_groups_in_many_blocks_and_unlike_centers(spark, make_docs, near_copies, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 2)
    with_center = jaccard_join._with_center  # as if no center of three and more were like any member
    monkeypatch.setattr(jaccard_join, "_with_center", lambda members: with_center(members.filter("size = 2")))
    ids = list(range(len(near_copies)))
    check_join(jaccard_join.join(make_docs(list(enumerate(near_copies)))).toPandas(), ids, near_copies)


def test_rows_at_places_in_several_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "FLAG_BYTES", 20)
    path = str(tmp_path / "placed")
    spark.range(0, 3000, 1, 7).select("id", F.lit("x").alias("_part"), F.lit("y").alias("_file")).write.parquet(path)
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    stored = spark.read.parquet(path)
    for docs in (stored, stored.select("_part", "id"), stored.union(stored.limit(0)), spark.createDataFrame([(5, "z")], "id bigint, _part string")):
        places = common.Places(docs)
        for wanted in ("id % 7 = 3", "id = 2999", "id < 5 or id > 2990", "id < 0", "true"):
            found = common.staged(places.rows("row").filter(wanted).select("row"), "wanted")
            spark.conf.set(key, "1000")  # a later scan cuts the files otherwise
            got = places.rows_at(found, "row")
            spark.conf.set(key, before)
            assert got.columns == [*docs.columns, "row"]
            assert sorted(r.id for r in got.collect()) == sorted(r.id for r in docs.filter(wanted).collect())
