"""The pipeline, stage by stage, against brute force."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
import pytest

import corpus_pipeline
from llm.conftest import AWKWARD
from llm.test_sets import contamination, joined
from llm.test_texts import base
from llm.test_tokens import check_packing
from novalake.llm import pii
from novalake.llm.common import shared_code

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """Each stage's output, written and read again, from all documents."""
    shared_code(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t.parquet")
        stage(spark, docs, SF).write.parquet(path)
        docs = found[name] = spark.read.parquet(path)
    return {name: df.toPandas() for name, df in found.items()}, found


def test_stages_keep_the_columns(outputs):
    _, frames = outputs
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert frames[name].schema == frames["documents"].schema
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "personal_data", "packing"]


def test_known_languages_stay(outputs):
    tables, _ = outputs
    letters = tables["documents"]["text"].map(lambda t: any(map(str.isalpha, t)))
    assert set(tables["language"]["doc_id"]) <= set(tables["documents"][letters]["doc_id"])
    assert len(tables["language"]) >= 0.99 * letters.sum()


def test_one_document_of_each_group_stays(outputs):
    tables, _ = outputs
    before = tables["language"]
    _, roots = joined(before["text"].tolist())
    least = defaultdict(lambda: 1 << 62)
    for doc, root in zip(before["doc_id"], roots):
        least[root] = min(least[root], doc)
    assert sorted(tables["near_duplicates"]["doc_id"]) == sorted(least.values())


def test_contaminated_documents_go_and_others_stay(outputs):
    tables, _ = outputs
    before, items = tables["near_duplicates"], pd.read_parquet(f"{SF}/benchmark.parquet")
    found = contamination(before["text"], zip(items["item_id"], items["text"]))
    kept = before[[not f[4] for f in found]]
    assert 0 < len(kept) < len(before)
    pd.testing.assert_frame_equal(tables["decontamination"].sort_values("doc_id").reset_index(drop=True),
                                  kept.sort_values("doc_id").reset_index(drop=True))


def test_base_spans_are_masked(outputs):
    tables, _ = outputs
    before, after = (tables[n].set_index("doc_id") for n in ("decontamination", "personal_data"))
    assert sorted(before.index) == sorted(after.index)
    changed = 0
    for doc, text in before["text"].items():
        masked, spans = after["text"][doc], base(text)
        changed += masked != text
        if spans:
            assert masked != text and base(masked) == [] and after["n_chars"][doc] == len(masked)
            if masked.count("[") - text.count("[") == len(spans):
                assert masked == pii.mask(text, spans)
        elif masked == text:
            assert after["n_chars"][doc] == before["n_chars"][doc]
    assert changed


def test_all_that_is_left_is_packed(outputs):
    tables, _ = outputs
    left = tables["personal_data"]
    check_packing(tables["packing"], list(zip(left["doc_id"], left["text"])), 4096)


def test_run_gives_the_last_stage(spark, outputs):
    tables, _ = outputs
    got = corpus_pipeline.run(spark, SF).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    mine, other = (t[columns].sort_values(columns).reset_index(drop=True) for t in (got, tables["packing"]))
    pd.testing.assert_frame_equal(mine, other)


def test_stages_take_awkward_and_empty_tables(spark, awkward, make_docs):
    for docs in (awkward, make_docs([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.schema == docs.schema
            assert out.count() <= 4 * len(AWKWARD)
