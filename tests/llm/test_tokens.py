"""Token store and packing, against the tokenizer library run on whole texts."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import AWKWARD
from novalake.llm import packing, token_store
from novalake.llm.queries import op1_token_store, op2_packing, tokenizer_path
from novalake.llm.tokens import encoder

SF = "/root/testdata/sf0.001"


def whole(text):
    return np.frombuffer(encoder(tokenizer_path()).whole(text or ""), "<u2").astype("<u4")


def test_words_are_encoded_as_in_whole_texts():
    encode = encoder(tokenizer_path())
    texts = [r[1] or "" for r in AWKWARD] + ["o'tis 'tis 're're it''s", "\t\x0b\x1c a", "é DON'T Å", "x" * 300, "a²µ ª"]
    for text in texts:
        assert encode.encode(text) == encode.whole(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZé'sß×\n\t !2#<|>İ́K"), max_size=40))
def test_any_text_is_encoded_as_a_whole(text):
    encode = encoder(tokenizer_path())
    assert encode.encode(text) == encode.whole(text)


@given(st.sets(st.integers(-(2**63) + 1, 2**63 - 1), max_size=300))
@settings(max_examples=30, deadline=None)
def test_perfect_hash_gives_each_key_its_own_slot(keys):
    hashes = token_store.hashed_key(np.array(sorted(keys), np.int64), np.zeros(len(keys), np.int64))
    table = token_store.PerfectHash.unpacked(*token_store.PerfectHash.of(hashes).packed())
    assert sorted(table.slots(hashes)) == list(range(len(keys)))


@pytest.fixture(scope="module")
def store(spark, awkward, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('store')}"
    token_store.write_store(awkward, path, tokenizer_path(), shards=4)
    return path


def test_store_holds_all_documents_in_order(spark, store):
    got = token_store.read_back(spark, store).toPandas()
    expected = Counter()
    for doc, text, *_ in AWKWARD:
        ids = np.append(whole(text), 2).astype("<u4")
        expected[(doc, len(ids), zlib.crc32(ids))] += 1
    rows = list(zip(got["doc_id"].astype("Int64"), got["n_tokens"], got["ids_crc32"]))
    assert Counter((None if pd.isna(d) else int(d), n, c) for d, n, c in rows) == expected
    got = got.sort_values("start")
    assert (got["start"].to_numpy() == np.cumsum(got["n_tokens"]) - got["n_tokens"]).all()
    ids = got["doc_id"].astype("Int64").fillna(-(2**62)).tolist()
    assert ids == sorted(ids)


def test_lookup_finds_all_copies_and_nothing_else(spark, store):
    keys = spark.createDataFrame([(5,), (5,), (6,), (1 << 40,), (123456789,)], "doc_id bigint")
    got = token_store.lookup(spark, store, keys).groupBy("key").sum("count").collect()
    assert dict(got) == {5: 3, 1 << 40: 1}


def test_hot_key_spans_shards(spark, make_docs, tmp_path):
    rows = [(1, f"copy {i}") for i in range(400)] + [(i, "x") for i in range(2, 60)]
    path = f"file://{tmp_path}/s"
    token_store.write_store(make_docs(rows), path, tokenizer_path(), shards=5)
    assert token_store.payload(spark, path).filter("array_contains(keys, 1L)").select("shard").distinct().count() > 1
    assert token_store.read_back(spark, path).groupBy("doc_id").count().filter("doc_id = 1").first()["count"] == 400


def test_empty_store(spark, make_docs, tmp_path):
    path = f"file://{tmp_path}/s"
    token_store.write_store(make_docs([]), path, tokenizer_path(), shards=2)
    assert token_store.read_back(spark, path).count() == 0
    assert token_store.lookup(spark, path, spark.range(3).withColumnRenamed("id", "doc_id")).count() == 0


def check_packing(got, texts, capacity):
    expected = Counter()
    for doc, text in texts:
        ids = np.append(whole(text), 1).astype("<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            expected[(doc, piece, start, len(part), zlib.crc32(part))] += 1
    ids = [None if pd.isna(d) else int(d) for d in got["doc_id"].astype("Int64")]
    assert Counter(zip(ids, got["piece"], got["start"], got["length"], got["ids_crc32"])) == expected
    for _, group in got.sort_values("offset").groupby("sequence_id"):
        assert (group["offset"].to_numpy() == np.cumsum(group["length"]) - group["length"]).all()
        assert group["length"].sum() <= capacity


def test_awkward_documents_are_packed(awkward):
    got = packing.pack_documents(awkward, tokenizer_path(), capacity=64).toPandas()
    check_packing(got, [r[:2] for r in AWKWARD], 64)


def test_empty_table_is_packed(make_docs):
    assert packing.pack_documents(make_docs([]), tokenizer_path()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_plan_places_every_piece_once(lengths):
    counts = Counter(lengths)
    made = packing.plan(counts, 30)
    fill, seen, large = Counter(), Counter(), Counter()
    for length, runs in made.runs.items():
        for first, stop, sequence, each, offset in runs:
            for rank in range(first, stop):
                at = sequence + (rank - first) // each
                seen[length] += 1
                large[at] += 3 * length > 30
                for cell in range(length):
                    place = offset + (rank - first) % each * length + cell
                    assert place < 30
                    fill[(at, place)] += 1
    assert seen == counts
    assert all(v == 1 for v in fill.values())
    assert all(v <= 2 for v in large.values())
    per = Counter(at for at, _ in fill)
    assert all((at, p) in fill for at, n in per.items() for p in range(n))  # no holes inside
    assert made.sequences == len(per)
    assert made.sequences <= 11 / 9 * max(-(-sum(lengths) // 30), sum(2 * n > 30 for n in lengths)) + 2


def test_queries_on_documents(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    got = op1_token_store(spark, SF).toPandas().sort_values("doc_id")
    ids = [np.append(whole(t), 2).astype("<u4") for t in docs["text"]]
    sizes = np.array([len(i) for i in ids])
    assert got["doc_id"].tolist() == docs["doc_id"].tolist()
    assert got["n_tokens"].tolist() == sizes.tolist()
    assert got["start"].tolist() == (np.cumsum(sizes) - sizes).tolist()
    assert got["ids_crc32"].tolist() == [zlib.crc32(i) for i in ids]
    packed = op2_packing(spark, SF).toPandas()
    check_packing(packed, list(zip(docs["doc_id"], docs["text"])), 4096)
    assert packed["sequence_id"].nunique() <= -(-packed["length"].sum() // 4096) + 1
