"""Scores of whole texts: a unigram base over words, and context-tree weighting over bytes.

All counts come from all training documents. The words that make up a ten-thousandth of the corpus
each, at most ten thousand, go to every task. The other words of a text are asked for in the bucket
that counts them: a block of documents sends its distinct words with the documents they are in, and
gets back a sum for each document. Bytes with their contexts likewise: every counted context stays in
the trees, which are cut by the last three bytes of the context into buckets. The nodes of up to two bytes
of context go to every task, as do the scores of the bytes after contexts that make up a 2**-20 share
of the corpus each; the others are asked for by bucket.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from novalake.llm.common import pack_longs, slices, staged, texts_of, unpack_longs
from novalake.llm.context_tree import TOP, LogTable, Top, grams, low_bytes, lower_tree, nodes_of, parents

HOT_WORDS = 10_000
HOT_GRAMS = 1 << 20
HELD = 1 << 20  # distinct words or contexts a task holds before it hands them on
WORDS_PER_BUCKET = 2_000_000
BYTES_PER_BUCKET = 16 << 20
GRAMS_PER_BUCKET = 250_000
END = -1
WORDS, GRAMS = 0, 1
MIX = 2654435769


def held_out(key: str = "doc_id") -> Column:
    """A fifth of the documents by the hash of their id; without id, none."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 1, F.lit(False))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words, A-Z lower-cased, cut at ASCII white space. They stand for the
    words; two of a billion distinct words share one with a probability of 3 %."""
    words = text.lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts_of(batch, "body")]


class _Tally:
    """Counts of 64-bit numbers, gathered in sorted parts."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, numbers: np.ndarray) -> None:
        keys, counts = np.unique(numbers, return_counts=True)
        self.parts.append((keys.astype(np.uint64), counts))
        self.size += len(keys)
        if self.size > HELD:
            self.merge()

    def merge(self) -> None:
        if self.parts:
            keys, at = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([p[1] for p in self.parts]).astype(float), len(keys))
            self.parts, self.size = [(keys, counts.astype(np.int64))], len(keys)

    def rows(self, kind: int):
        self.merge()
        for keys, counts in self.parts:
            for start in range(0, len(keys), 1 << 17):
                part = slice(start, start + (1 << 17))
                yield pa.RecordBatch.from_pydict({
                    "kind": np.full(len(keys[part]), kind, np.int32), "key": keys[part].view(np.int64),
                    "n": counts[part]})
        self.parts, self.size = [], 0


def corpus_counts(training: DataFrame) -> DataFrame:
    """``kind, key, n`` over all ``body``: words (0), bytes with their contexts (1), texts (2)."""
    def count(batches):
        words, bytes_, texts = _Tally(), _Tally(), 0
        for batch in slices(batches, "body"):
            bodies = _encoded(batch)
            texts += len(bodies)
            words.add(np.concatenate([word_hashes(b) for b in bodies]))
            bytes_.add(grams(bodies)[0])
            for kind, tally in enumerate((words, bytes_)):
                if tally.size > HELD // 2:
                    yield from tally.rows(kind)
        for kind, tally in enumerate((words, bytes_)):
            yield from tally.rows(kind)
        yield pa.RecordBatch.from_pydict({
            "kind": np.array([2], np.int32), "key": np.array([END], np.int64), "n": np.array([texts], np.int64)})

    counted = training.mapInArrow(count, "kind int, key bigint, n bigint")
    return staged(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")


def _bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the last ``TOP + 1`` bytes of the context of each number are counted, as :func:`_gram_bucket`."""
    suffix = (codes >> np.uint64(8)) & np.uint64((1 << 8 * (TOP + 1)) - 1)
    mixed = (suffix * np.uint64(MIX) & np.uint64(0xFFFFFFFF)) >> np.uint64(8)
    return (mixed % np.uint64(buckets)).astype(np.int64)


def _gram_bucket(buckets: int) -> Column:
    suffix = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (TOP + 1)) - 1))
    mixed = F.shiftright((suffix * F.lit(MIX)).bitwiseAND(F.lit(0xFFFFFFFF)), 8)
    return (mixed % F.lit(buckets)).cast("int")


def _sorted_counts(counts: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys = counts["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], counts["n"].to_numpy(np.int64)[order]


def _upper_sums(counts: pd.DataFrame) -> pd.DataFrame:
    """What the contexts of a bucket add to the nodes at ``TOP``."""
    codes, n = _sorted_counts(counts)
    below = lower_tree(codes, n).below
    keys, zeros, ones = nodes_of(*low_bytes(codes, n, TOP + 1))
    up, zeros, ones, split = parents(keys, TOP, zeros, ones, below)
    return pd.DataFrame({"node": up.view(np.int64), "zeros": zeros, "ones": ones, "split": split})


def _model(grams_: DataFrame, total: int) -> tuple[Top, LogTable]:
    """Nodes of short contexts, and the scores of the most frequent bytes with their contexts."""
    sums = grams_.groupBy("bucket").applyInPandas(_upper_sums, "node bigint, zeros double, ones double, split double")
    sums = sums.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "split"))).toPandas()
    top = Top(sums["node"].to_numpy(np.int64).view(np.uint64),
              *(sums[c].to_numpy(float) for c in ("zeros", "ones", "split")))
    shared = grams_.sparkSession.sparkContext.broadcast(top)

    def hot(counts: pd.DataFrame) -> pd.DataFrame:
        codes, n = _sorted_counts(counts)
        often = codes[n * HOT_GRAMS >= total]
        logs = lower_tree(codes, n, shared.value).log10(often) if len(often) else np.zeros(0)
        return pd.DataFrame({"key": often.view(np.int64), "log": logs})

    got = grams_.groupBy("bucket").applyInPandas(hot, "key bigint, log double").toPandas()
    return top, LogTable(got["key"].to_numpy(np.int64).view(np.uint64), got["log"].to_numpy(float))


DOCS = ("docs binary, no_id binary, held array<boolean>, tokens array<bigint>, known array<bigint>, "
        "base array<double>, score array<double>")
BLOCK = f"bucket int, block bigint, kind int, words binary, per_word binary, rows binary, times binary, {DOCS}"
SUMS = f"block bigint, kind int, at binary, sums binary, hits binary, {DOCS}"
DOC_FIELDS = ["docs", "no_id", "held", "tokens", "known", "base", "score"]


def score(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` for
    every row.

    A null or empty text has the end token alone, and the model's stop. Without training documents
    every count is 0 and the model gives each decision a half.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(key).cast("bigint").alias("doc"), held_out(key).alias("held"),
                       F.coalesce(F.col(text), F.lit("")).alias("body"))
    counts = corpus_counts(slim.filter(~F.col("held")).select("body"))
    words = counts.filter("kind = 0").select("key", "n")
    sizes = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}
    (n_words, distinct), (n_grams, distinct_grams), (ends, _) = (
        (sizes[kind]["n"], sizes[kind]["rows"]) if kind in sizes else (0, 0) for kind in range(3))
    total, types = n_words + ends, distinct + (ends > 0)
    norm = float(np.log10(total + 0.5 * (types + 1)))
    hot = words.filter(F.col("n") * HOT_WORDS >= n_words).toPandas().sort_values("key")
    hot_keys = hot["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hot_keys)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, n_words // WORDS_PER_BUCKET, n_grams // BYTES_PER_BUCKET,
                  distinct_grams // GRAMS_PER_BUCKET)
    grams_ = counts.filter("kind = 1").withColumn("bucket", _gram_bucket(buckets))
    top, table = _model(grams_, n_grams) if n_grams else (None, None)
    model = spark.sparkContext.broadcast((hot_keys[order], hot["n"].to_numpy(np.int64)[order], table))
    upper = spark.sparkContext.broadcast(top)

    blocks = slim.withColumn("part", F.spark_partition_id()).mapInArrow(
        _ask(model, ends, buckets), BLOCK)
    cold = words.filter(F.col("n") * HOT_WORDS < n_words).withColumn("kind", F.lit(WORDS))
    cold = cold.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int")).unionByName(grams_)
    sums = blocks.groupBy("bucket").cogroup(cold.groupBy("bucket")).applyInPandas(_answer(upper), SUMS)
    parts = sums.groupBy("block").applyInPandas(
        _collect, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, score double")
    return parts.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(norm)).alias("base_score"), "score")


def _ask(model, ends: int, buckets: int):
    """Blocks of documents: what is known of them here, and the words to be asked for by bucket."""
    nothing = dict.fromkeys(("kind", "words", "per_word", "rows", "times", *DOC_FIELDS))

    def run(batches):
        hot_keys, hot_counts, table = model.value
        hot_logs, end_log, n_block = np.log10(hot_counts + 0.5), np.log10(ends + 0.5), 0
        schema = pa.schema([
            ("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("words", pa.binary()),
            ("per_word", pa.binary()), ("rows", pa.binary()), ("times", pa.binary()), ("docs", pa.binary()), ("no_id", pa.binary()),
            ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64())), ("known", pa.list_(pa.int64())),
            ("base", pa.list_(pa.float64())), ("score", pa.list_(pa.float64()))])
        for batch in slices(batches, "body"):
            block = batch.column("part")[0].as_py() << 32 | n_block
            n_block += 1
            bodies = _encoded(batch)
            hashes = [word_hashes(b) for b in bodies]
            lengths = np.array([len(h) for h in hashes])
            rows = np.repeat(np.arange(len(bodies)), lengths)
            hashes = np.concatenate(hashes)
            found, at = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
            if len(hot_keys):
                at = np.minimum(np.searchsorted(hot_keys, hashes), len(hot_keys) - 1)
                found = hot_keys[at] == hashes
            base = np.bincount(rows[found], hot_logs[at[found]], len(bodies)) + end_log
            known = np.bincount(rows[found], minlength=len(bodies)) + (ends > 0)
            codes, sizes = grams(bodies)
            logs = table.find(codes) if table else np.full(len(codes), 8 * np.log10(0.5))
            rare = np.flatnonzero(np.isnan(logs))
            logs[rare] = 0
            scores = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
            found_ids, no_id = pack_longs(batch.column("doc"))
            out = [nothing | {
                "bucket": block % buckets, "block": block, "docs": found_ids, "no_id": no_id,
                "held": batch.column("held").to_pylist(), "tokens": lengths + 1, "known": known,
                "base": base, "score": scores}]
            cold = hashes[~found]
            out += _questions(cold, rows[~found], (cold.view(np.int64) % buckets).astype(np.int64), block,
                              nothing | {"kind": WORDS})
            of_gram = np.repeat(np.arange(len(bodies)), sizes)[rare]
            out += _questions(codes[rare], of_gram, _bucket_of(codes[rare], buckets), block, nothing | {"kind": GRAMS})
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _questions(hashes: np.ndarray, rows: np.ndarray, bucket: np.ndarray, block: int, nothing: dict) -> list[dict]:
    """A row for each bucket: distinct words (or bytes with contexts), for each the documents with it and how often."""
    if not len(hashes):
        return []
    order = np.lexsort((rows, hashes, bucket))
    bucket, hashes, rows = bucket[order], hashes[order], rows[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1]))
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(hashes)))
    bucket, hashes, rows = bucket[first], hashes[first], rows[first]
    out, edges = [], np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(bucket)]):
        starts = np.flatnonzero(np.append(True, hashes[a + 1 : b] != hashes[a : b - 1]))
        out.append(nothing | {
            "bucket": int(bucket[a]), "block": block, "words": hashes[a:b][starts].tobytes(),
            "per_word": np.diff(np.append(starts, b - a)).astype(np.uint32).tobytes(),
            "rows": rows[a:b].astype(np.uint32).tobytes(), "times": times[a:b].astype(np.uint32).tobytes()})
    return out


def _answer(upper):
    """For each block of a bucket: documents with words (bytes) of the bucket, sums of logarithms, known words."""
    def run(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        words, n_words = _sorted_counts(counts[counts["kind"] == WORDS])
        asked = [np.frombuffer(w, np.uint64) for w in blocks.loc[blocks["kind"] == GRAMS, "words"]]
        if asked:
            asked = np.unique(np.concatenate(asked))
            gram_logs = lower_tree(*_sorted_counts(counts[counts["kind"] == GRAMS]), upper.value).log10(asked)
        out = []
        for r in blocks.itertuples():
            if r.words is None:
                out.append((r.block, None, None, None, None, *(getattr(r, f) for f in DOC_FIELDS)))
                continue
            mine, per_word = np.frombuffer(r.words, np.uint64), np.frombuffer(r.per_word, np.uint32)
            times = np.frombuffer(r.times, np.uint32)
            rows, at = np.unique(np.frombuffer(r.rows, np.uint32), return_inverse=True)
            hits = None
            if r.kind == GRAMS:
                logs = np.repeat(gram_logs[np.searchsorted(asked, mine)], per_word)
            else:
                count = np.zeros(len(mine), np.int64)
                if len(words):
                    found = np.minimum(np.searchsorted(words, mine), len(words) - 1)
                    count = np.where(words[found] == mine, n_words[found], 0)
                count = np.repeat(count, per_word)
                logs = np.log10(count + 0.5)
                hits = np.bincount(at, times * (count > 0), len(rows)).astype(np.uint32).tobytes()
            sums = np.bincount(at, times * logs, len(rows))
            out.append((r.block, r.kind, rows.tobytes(), sums.tobytes(), hits, *[None] * len(DOC_FIELDS)))
        return pd.DataFrame(out, columns=["block", "kind", "at", "sums", "hits", *DOC_FIELDS])
    return run


def _collect(parts: pd.DataFrame) -> pd.DataFrame:
    """The answers to one block, added up for each of its documents."""
    mine = parts[parts["docs"].notna()].iloc[0]
    logs, known = np.array(mine["base"], float), np.array(mine["known"], np.int64)
    score = np.array(mine["score"], float)
    for r in parts[parts["at"].notna()].sort_values(["kind", "at", "sums"]).itertuples():
        rows = np.frombuffer(r.at, np.uint32)
        if r.kind == GRAMS:
            score[rows] += np.frombuffer(r.sums, np.float64)
        else:
            logs[rows] += np.frombuffer(r.sums, np.float64)
            known[rows] += np.frombuffer(r.hits, np.uint32)
    return pd.DataFrame({
        "doc_id": unpack_longs(mine["docs"], mine["no_id"]), "held_out": mine["held"], "n_tokens": mine["tokens"],
        "n_known": known, "logs": logs, "score": score})
