"""Differences between sources against brute force, and the transducer against sorted lists."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import AWKWARD, EXTRA, LONG
from novalake.llm import source_divergence
from novalake.llm.queries import op12_source_divergence
from novalake.llm.source_divergence import divergence
from novalake.llm.transducer import Transducer


@settings(max_examples=150, deadline=None)
@given(st.sets(st.binary(max_size=6).map(lambda b: bytes(x % 4 + 97 for x in b)), max_size=60),
       st.lists(st.binary(max_size=5), max_size=10))
def test_transducer_is_minimal_and_gives_ordinals(terms, others):
    ordered = sorted(terms)
    automaton = Transducer.unpacked(Transducer.of(ordered).packed())
    assert automaton.ordinals(ordered).tolist() == list(range(len(ordered)))
    assert [automaton.term(n) for n in range(len(ordered))] == ordered
    strange = [o for o in others if o not in terms]
    assert automaton.ordinals(strange).tolist() == [-1] * len(strange)
    endings = {frozenset(t[len(p):] for t in terms if t.startswith(p))
               for p in {t[:n] for t in terms for n in range(len(t) + 1)} - {b""}}
    assert len(automaton.final) <= len(endings) + 1  # one state for each set of endings, and the start


def brute(rows, least=10, top=10):
    docs = [tuple(x or "" for x in r) for r in rows]  # lang, source, text
    words = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
             for lang, source, text in docs]
    df = Counter((lang, w) for lang, _, found in words for w in set(found))
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= least:
            kept[lang].append(w)
    counts = Counter((lang, source, w) for lang, source, found in words for w in found if w in set(kept[lang]))
    sources = defaultdict(set)
    for lang, source, _ in words:
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        terms = kept[lang]
        def share(n, total):
            return 1 + 1_000_000_000 * (n + 2) // (total + 2 * len(terms))
        def apart(p, q):
            return (p - q) ** 2 // (p + q)
        totals = {s: sum(counts[lang, s, w] for w in terms) for s in names}
        p = {(s, w): share(counts[lang, s, w], totals[s]) for s in names for w in terms}
        q = {w: share(sum(counts[lang, s, w] for s in names), sum(totals.values())) for w in terms}
        for s in names:
            pairs = [(-sum(apart(p[s, w], p[o, w]) for w in terms), o.encode(), o) for o in names if o != s]
            best = [(-apart(p[s, w], q[w]), w.encode(), w) for w in terms if counts[lang, s, w] and p[s, w] > q[w]]
            out += [(lang, s, "pair", i, -v, n) for n, (v, _, i) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", i, -v, n) for n, (v, _, i) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def table(spark, rows, partitions=4):
    extra = [n for n in EXTRA if n not in ("text_u",)] + ["shard", "ordinal", "term", "value", "lang_total", "v"]
    df = spark.createDataFrame([(n, r[2], r[0], r[1], *extra) for n, r in enumerate(rows)], (
        "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in extra)))
    return df.repartition(partitions) if rows else df


def results(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(source_divergence, "SHARD_TERMS", 40)
    monkeypatch.setattr(source_divergence, "BLOCK_BYTES", 4_000)
    monkeypatch.setattr(source_divergence, "TERM_ROWS", 7)
    monkeypatch.setattr(source_divergence, "HELD", 50)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, small_pieces, seed):
    draw = random.Random(seed)
    words = [draw.choice("aäbßc") * draw.randrange(1, 4) + draw.choice("xyzéñ中") + str(n % 3) + chr(97 + n % 26) for n in range(150)]
    rows = [(draw.choice(["en", "de", None, ""]), draw.choice(["s0"] * 4 + ["s1", "Ä", None, "", "z"]),
             " ".join(draw.choice([w, w.upper()]) for w in draw.choices(words, k=draw.randrange(0, 30)))) for _ in range(300)]
    assert results(divergence(table(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    rows = [(lang, "s" if n % 2 else None, text) for n, (_, text, lang) in enumerate(AWKWARD)]
    rows += [("en", "t", "Same words\u0085here, İ same"), ("en", "s", "words only")] * 12  # copies count as documents
    rows += [("xx", "a", "rare"), ("xx", "b", "other"), ("xx", None, None), ("yy", "one", "alone")]  # no kept term
    rows += [("de", "long", LONG)] * 10
    assert results(divergence(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    df = divergence(table(spark, []))
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"] and not df.collect()


def test_query(spark):
    got = op12_source_divergence(spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "source", "text").collect()
    assert results(got) == brute(map(tuple, rows))
