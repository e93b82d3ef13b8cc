"""The trie of conversation prefixes against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from novalake.llm import prefix_trie
from novalake.llm.prefix_trie import NodeTable, Turns, trie
from novalake.llm.queries import op13_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """From (conv_id, turn, role, text)."""
    own = defaultdict(list)
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (
        r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, _, role, text in order:
        own[conv].append((role or "", text or ""))
    if not own:
        return []
    members = defaultdict(list)
    ends = defaultdict(list)
    for conv in own:
        base, cut = conv - int(math.fmod(conv, 5)), zlib.crc32(str(conv).encode()) % 9
        full = own.get(base, [])[:cut] + own[conv][cut:]
        for d in range(len(full) + 1):
            members[tuple(full[:d])].append(conv)
        ends[tuple(full)].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        mine = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = mine + sum(saved[c] for c in children[node])
    return sorted((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]),
                   leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
                  for n in members)


def results(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=lambda r: tuple((x is not None, x) for x in r))


def expected(rows):
    return sorted(brute(rows), key=lambda r: tuple((x is not None, x) for x in r))


def table(spark, rows, partitions=4):
    df = spark.createDataFrame([(*r, 1, 2, "a", "b", 3) for r in rows], (
        "conv_id bigint, turn bigint, role string, text string, shard int, depth int, base string, size string, n int"))
    return df.repartition(partitions) if rows else df


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_conversations(spark, monkeypatch, seed):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 100)
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-20, 130), 110):
        for turn in range(draw.choice([1, 1, 2, 3, 5, 8, 12, 20])):
            rows.append((conv, turn, draw.choice(["user", "bot", None]), draw.choice(["", None, "a", "ß", "long text"])))
    assert results(trie(table(spark, rows))) == expected(rows)


def test_one_conversation_over_many_shards_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 100)
    body = [("user" if n % 2 else "bot", f"t{n * n % 97}") for n in range(300)]
    rows = [(conv, n, role, text) for conv in (5, 10, 11, 12, 13, 14, 20) for n, (role, text) in enumerate(body)]
    rows += [(conv, n, role, text) for conv in range(1000, 1200, 5) for n, (role, text) in enumerate(body[:2])]
    rows += [(25, None, None, None)] * 200 + [(25, 1, "x", "y")]
    assert results(trie(table(spark, rows))) == expected(rows)


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "no id"), (0, None, "user", "first"), (0, None, "bot", "tie"), (0, 0, None, None), (0, 0, None, None),
            (1, 3, "user", "x" * 200_000), (3, 1, "", ""), (7, 5, "a", "b"), (8, 5, "a", "b"), (-3, 1, "user", "é\0中"),
            (-5, 1, "user", "first"), (-6, 2, "user", "first"), (1 << 61, 1, "ab", "c"), ((1 << 61) + 5, 1, "a", "bc")]
    assert results(trie(table(spark, rows))) == expected(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_empty(spark, rows):
    df = trie(table(spark, rows))
    assert df.columns == COLUMNS and not df.collect()


def test_single_and_turnless(spark):
    turnless = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(turnless, 0, "user", "only")]
    assert results(trie(table(spark, rows))) == expected(rows)
    assert len(expected(rows)) == 1


def test_slots_tell_strangers():
    digest = np.array([[1, 2], [3, 4], [1, 2]], np.uint64)
    flags, ones = np.ones(3, bool), np.ones(3, np.int64)
    nodes = NodeTable(Turns(np.arange(3), ones, digest, np.zeros((3, 2), np.uint64), ones, ones, ~flags, flags, flags))
    assert sorted(nodes.slots(np.array([[0, 0], [1, 2], [3, 4]], np.uint64)).tolist()) == [0, 1, 2]
    strangers = np.stack([np.arange(5, 60, dtype=np.uint64)] * 2, axis=1)
    assert (nodes.slots(strangers) == -1).all()
    assert nodes.gathered(np.ones(3, np.int64), np.add)[nodes.slots(np.zeros((1, 2), np.uint64))] == 3


def test_query(spark):
    got = op13_prefix_trie(spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert results(got) == expected(list(map(tuple, rows.collect())))
