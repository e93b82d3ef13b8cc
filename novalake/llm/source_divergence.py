"""How far the sources of a language differ in their words, and by which words.

The vocabulary of a language is the terms that stand in enough of its documents. Its sorted terms are cut
into shards, each a minimal acyclic transducer that gives a term its ordinal in byte order. Then all texts
are streamed through the transducers, and only ordinals and counts leave the tasks. Ties between terms are
broken by ordinal; a term's text is read back from its transducer at the very end.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from novalake.llm.common import slices, staged
from novalake.llm.transducer import Transducer

LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
SHARD_TERMS, SHARD_BYTES = 1 << 15, 4 << 20
BLOCK_BYTES = 32 << 20
TERM_ROWS = 1 << 11
HELD = 400_000

# Letters of plain Latin in lower case and bytes of all other characters stay; the rest parts terms.
_KEPT = bytes(b | 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))

SHARD = "lang string, part int, nth int, terms bigint, first binary, bytes bigint, arcs binary, targets binary, " \
        "outputs binary, final binary"
COUNTED = "lang string, source string, shard int, ordinal int, n bigint"
AUDIT = "part string, source string, other string, ordinal int, value bigint"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_KEPT).split()


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def document_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, n``: in how many documents of a language each term stands."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("n", pa.int64())])

    def count(batches):
        held: dict[str, Counter] = defaultdict(Counter)

        def rows():
            for lang, found in held.items():
                yield pa.record_batch([pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()),
                                       pa.array(list(found.values()), pa.int64())], schema)
            held.clear()

        for batch in slices(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), _texts(batch)):
                held[lang].update(set(terms_of(text)))
            if sum(map(len, held.values())) >= HELD:
                yield from rows()
        yield from rows()

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, term binary, n bigint")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def vocabulary(kept: DataFrame) -> DataFrame:
    """Shards of the kept terms (``lang, term``) in order, each a transducer."""
    schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[t])
                        for n, t in (c.split() for c in SHARD.split(", "))])

    def build(batches):
        lang, part, nth, terms, held = None, 0, 0, [], 0

        def row():
            packed = Transducer.of(terms).packed()
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, [
                lang, part, nth, len(terms), terms[0], sum(map(len, packed)), *packed]))], schema)

        for batch in batches:
            for one, p, term in zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "term"))):
                if terms and (one != lang or len(terms) >= SHARD_TERMS or held >= SHARD_BYTES):
                    yield row()
                    nth, terms, held = nth + 1, [], 0
                lang, part = one, p
                terms.append(term)
                held += len(term)
        if terms:
            yield row()

    kept = staged(kept, "kept-terms")
    parts = -(-kept.count() // SHARD_TERMS) or 1
    ranged = kept.repartitionByRange(parts, "lang", "term").withColumn("part", F.spark_partition_id())
    return staged(ranged.sortWithinPartitions("lang", "term").mapInArrow(build, SHARD), "transducers")


def recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """``lang, source, shard, ordinal, n`` for all kept terms with an occurrence: the texts are streamed through
    the transducers. These go out in blocks of at most BLOCK_BYTES (or one shard), one after the other."""
    spark = docs.sparkSession
    sizes = shards.select("shard", "bytes").orderBy("shard").collect()  # a row for SHARD_TERMS kept terms
    blocks, held = [], 0
    for shard, size in sizes:
        if not blocks or held + size > BLOCK_BYTES:
            blocks.append([shard, shard])
            held = 0
        blocks[-1][1] = shard
        held += size
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("shard", pa.int32()),
                        ("ordinal", pa.int32()), ("n", pa.int64())])

    def stream(shared):
        def count(batches):
            by_lang: dict[str, tuple] = {}
            for lang, shard, first, *parts in shared.value:
                numbers, firsts, automata = by_lang.setdefault(lang, ([], [], []))
                numbers.append(shard)
                firsts.append(first)
                automata.append(Transducer.unpacked(parts))
            groups: dict[tuple, int] = {}
            codes, counts, held = [], [], 0

            def merged():
                code, at = np.unique(np.concatenate(codes), return_inverse=True)
                return code, np.bincount(at, np.concatenate(counts), len(code)).astype(np.int64)

            def rows(code, n):
                langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
                group = pa.array(code >> 48)
                return pa.record_batch([langs.take(group), sources.take(group), pa.array(
                    (code >> 20) & (1 << 28) - 1, pa.int32()), pa.array(code & (1 << 20) - 1, pa.int32()),
                    pa.array(n)], schema)

            for batch in slices(batches, "text"):
                met: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
                for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source")), _texts(batch)):
                    if lang in by_lang:
                        met[lang][source].update(terms_of(text))
                for lang, found in met.items():
                    numbers, firsts, automata = by_lang[lang]
                    dealt = [[] for _ in numbers]
                    for term in set().union(*found.values()):
                        dealt[max(0, bisect_right(firsts, term) - 1)].append(term)
                    code_of = {}
                    for number, automaton, terms in zip(numbers, automata, dealt):
                        at = automaton.ordinals(terms)
                        code_of.update((t, number << 20 | o) for t, o in zip(terms, at.tolist()) if o >= 0)
                    for source, counter in found.items():
                        group = groups.setdefault((lang, source), len(groups))
                        hits = [(code_of[t], n) for t, n in counter.items() if t in code_of]
                        if hits:
                            code, n = np.array(hits, np.int64).T
                            codes.append(code | group << 48)
                            counts.append(n)
                            held += len(n)
                if held >= 8 * HELD or len(groups) >= 1 << 14:
                    code, n = merged() if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    codes, counts, held = [code], [n], len(code)
                    if held >= 4 * HELD or len(groups) >= 1 << 14:
                        yield rows(code, n)
                        codes, counts, held = [], [], 0
                        groups.clear()
            if codes:
                yield rows(*merged())

        return count

    found = []
    slim = docs.select("lang", "source", "text")
    for first, last in blocks:
        block = shards.filter(F.col("shard").between(first, last)).orderBy("shard")
        shared = spark.sparkContext.broadcast([
            (r["lang"], r["shard"], bytes(r["first"]), *(bytes(r[c]) for c in ("arcs", "targets", "outputs", "final")))
            for r in block.toLocalIterator()])
        counted = slim.mapInArrow(stream(shared), COUNTED)
        found.append(staged(counted.groupBy("lang", "source", "shard", "ordinal").agg(F.sum("n").alias("n")), "recounted"))
        shared.unpersist()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], COUNTED)


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), exact for totals under 2 ** 53: three digits of the base 1000."""
    left, out = counts + 2, np.zeros(np.broadcast_shapes(counts.shape, totals.shape), np.int64)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // totals
        left = left % totals
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _audit(groups: pa.Table, counts: pa.Table) -> pa.Table:
    """Some neighbouring terms of a language: sums for each pair of its sources, and each source's best terms."""
    out = {n: [] for n in ("part", "source", "other", "ordinal", "value")}
    groups = groups.sort_by("source")
    sources = groups["source"].to_pylist()
    ordinals, at = np.unique(counts["ordinal"].to_numpy(), return_inverse=True)
    number = {s: i for i, s in enumerate(sources)}
    seen = np.zeros((len(sources), len(ordinals)), np.int64)
    by = np.array([number[s] for s in counts["source"].to_pylist()], np.int64)
    seen[by, at] = counts["n"].to_numpy()
    p = shares(seen, groups["total"].to_numpy()[:, None])
    q = shares(seen.sum(axis=0), groups["lang_total"].to_numpy()[:1])

    def rows(part, source, others, places, values):
        for name, column in zip(out, ([part] * len(values), [source] * len(values), others, places, values)):
            out[name].extend(column)

    for i, source in enumerate(sources):
        sums = apart(p[i], p).sum(axis=1).tolist()
        rest = [j for j in range(len(sources)) if j != i]
        rows("pair", source, [sources[j] for j in rest], [None] * len(rest), [sums[j] for j in rest])
        mine = np.flatnonzero((seen[i] > 0) & (p[i] > q))
        value = apart(p[i][mine], q[mine])
        best = np.lexsort((mine, -value))[:TOP_TERMS]
        rows("term", source, [None] * len(best), ordinals[mine[best]].tolist(), value[best].tolist())
    return pa.table(out, schema=pa.schema([("part", pa.string()), ("source", pa.string()), ("other", pa.string()),
                                           ("ordinal", pa.int32()), ("value", pa.int64())]))


def _with_key(keys, table: pa.Table, schema: pa.Schema) -> pa.Table:
    for name, key in zip(("lang", "shard"), keys):
        table = table.append_column(name, pa.array([key.as_py()] * table.num_rows, schema.field(name).type))
    return table.select(schema.names)


def _spelled(key, shards: pa.Table, tops: pa.Table) -> pa.Table:
    if not tops.num_rows:
        return pa.table({n: [] for n in ("id", "term")}, schema=pa.schema([("id", pa.int64()), ("term", pa.binary())]))
    automaton = Transducer.unpacked([shards[c][0].as_py() for c in ("arcs", "targets", "outputs", "final")])
    return pa.table({"id": tops["id"], "term": pa.array([automaton.term(o) for o in tops["ordinal"].to_pylist()], pa.binary())})


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each (lang, source) of ``docs``.

    Part ``pair`` has a row for each other source of the language, part ``term`` for the ``top`` terms in which
    the source lies above its language. Null text, lang and source are empty strings, which are a language and a source like
    others. Repeated rows are documents of their own. A group without terms has pairs and no terms; in a language without
    kept terms all pairs have the value 0. An empty table gives no rows; other columns are ignored. Counts are exact up to
    2 ** 53 kept occurrences in a language.
    """
    spark = docs.sparkSession
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    groups = staged(docs.select("lang", "source").distinct(), "source-groups")
    kept = document_counts(docs).filter(F.col("n") >= least_docs).select("lang", "term")
    in_order = Window.orderBy("lang", "part", "nth")  # a row for SHARD_TERMS kept terms
    built = vocabulary(kept)
    numbers = staged(built.select("lang", "part", "nth", (F.row_number().over(in_order) - 1).alias("shard")), "shard-numbers")
    shards = built.join(numbers, ["lang", "part", "nth"])
    counts = recount(docs, shards)

    sizes = built.groupBy("lang").agg(F.sum("terms").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    by_lang = totals.groupBy("lang").agg(F.sum("n").alias("in_lang")).join(sizes, "lang")
    told = groups.join(by_lang, "lang", "left").join(totals, ["lang", "source"], "left")
    double = 2 * F.col("v")
    told = staged(told.select("lang", "source", "v", (F.coalesce("n", F.lit(0)) + double).alias("total"),
                              (F.col("in_lang") + double).alias("lang_total")), "group-totals")

    placed = counts.withColumn("slice", F.expr(f"ordinal div {TERM_ROWS}"))
    pieces = shards.select("lang", "shard", F.explode(
        F.expr(f"sequence(0L, (terms - 1) div {TERM_ROWS})")).alias("slice"))
    asked = pieces.join(told.filter("v is not null"), "lang")
    keys = ["lang", "shard", "slice"]
    audit_schema = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("part", pa.string()), ("source", pa.string()),
                              ("other", pa.string()), ("ordinal", pa.int32()), ("value", pa.int64())])
    audited = asked.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInArrow(
        lambda key, a, b: _with_key(key, _audit(a, b), audit_schema), "lang string, shard int, " + AUDIT)
    audited = staged(audited, "audited")

    pairs = audited.filter("part = 'pair'").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    none = told.filter("v is null")
    alike = none.select("lang", "source").join(none.select("lang", F.col("source").alias("item")), "lang").filter(
        "source <> item").withColumn("value", F.lit(0).cast("bigint"))
    group = Window.partitionBy("lang", "source")
    pairs = pairs.unionByName(alike).withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))

    best = group.orderBy(F.desc("value"), "shard", "ordinal")
    tops = audited.filter("part = 'term'").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    tops = staged(tops.select("lang", "source", "shard", "ordinal", "value", "rank", F.monotonically_increasing_id().alias(
        "id")), "top-terms")
    named = shards.select("shard", "arcs", "targets", "outputs", "final").groupBy("shard").cogroup(
        tops.select("shard", "ordinal", "id").groupBy("shard")).applyInArrow(_spelled, "id bigint, term binary")
    terms = tops.join(named, "id").select("lang", "source", F.col("term").cast("string").alias("item"), "value", "rank")

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))

    return part(pairs, "pair").unionByName(part(terms, "term"))
