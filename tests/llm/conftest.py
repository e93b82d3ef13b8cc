from __future__ import annotations

import random

import pytest

from novalake.llm.common import shared_code

# Columns with names that the operators use themselves.
EXTRA = ("size", "key", "rank", "part", "body", "doc", "found", "row", "text_u", "place", "label", "kind", "n")

LONG = " ".join(f"Wörter{i % 977} of{i % 31}" for i in range(12_000))


def docs_of(spark, rows, partitions=3):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, *EXTRA) for r in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"`{n}` string" for n in EXTRA)
    df = spark.createDataFrame(full, schema)
    return df.repartition(partitions) if rows else df


AWKWARD = [
    (5, "The quick brown fox, jumps over the lazy dog. It's 42!", "en"),
    (5, "The quick brown fox, jumps over the lazy dog. It's 42!", "en"),
    (5, "another text under the same id", "en"),
    (None, "a text without id", "en"),
    (None, None, None),
    (7, None, "de"),
    (8, "", "fr"),
    (9, " \n\t ", None),
    (10, LONG, "de"),
    (11, "İstanbul ΑΣ é ẞ 😀 <|endoftext|> x\u0085y", "tr"),
    (12, "12345 !!! ???", "en"),
    (-3, "a", "en"),
    (1 << 40, "'s 're don't ##2# Ünïcode", "en"),
]


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """Documents stored as a table, as the operators expect them."""
    shared_code(spark)

    def make(rows, partitions=3):
        path = str(tmp_path_factory.mktemp("docs") / "t.parquet")
        docs_of(spark, rows, partitions).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture
def near_copies():
    """Random texts, many of them edited copies of others."""
    draw = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(60):
        body = [draw.choice(words) for _ in range(draw.choice([1, 2, 4, 5, 6, 8, 10, 15, 30, 60, 150, 400]))]
        for _ in range(draw.choice([1, 1, 2, 3, 8])):
            copy = list(body)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 4, 6, 10])):
                if copy:
                    at, what = draw.randrange(len(copy)), draw.random()
                    if what < 0.4:
                        copy[at] = draw.choice(words)
                    elif what < 0.7:
                        del copy[at]
                    else:
                        copy.insert(at, draw.choice(words))
            texts.append(" ".join(copy))
    return texts
