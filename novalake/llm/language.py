"""Language of a text by sparse multinomial logistic regression on character n-grams.

Features are hashed 1- to 3-grams of the lower-case text, weighted by TF-IDF with document
frequencies counted over all training documents. The weights are learned by follow-the-regularised-
leader with elastic-net penalties on a bounded, stratified sample of whole documents; a part of the
sample that the learner does not see sets the temperature of the probabilities. A row is predicted from its text alone, so repeated
rows get the same answer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from novalake.llm.common import give_back_memory, slices, texts_of

BUCKETS = 1 << 14
SAMPLE_PER_LANGUAGE = 1_200
SAMPLE_DOCS = 12_000
EPOCHS = 2
UNKNOWN = "und"
MIN_SCORE = 0.3


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the n-gram buckets a text has, and how often. Runs of other characters than
    letters count as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    plain = (codes < 128) & ((codes < 97) | (codes > 122))
    codes = np.where(plain, 32, codes)
    if len(codes) > 1:
        codes = codes[np.append(True, ~(plain[1:] & plain[:-1]))]
    one = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + one[2:]
    found = np.concatenate((one, two, three))
    found = ((found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(50)
    counts = np.bincount(found.astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length 1."""
    values = (1 + np.log(counts)) * idf[at]
    return values / max(np.sqrt(values @ values), 1e-12)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int,
        alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1,
        epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal, one learning rate for each weight. ``rows`` are (buckets, values)."""
    z, n = np.zeros((classes, BUCKETS)), np.zeros((classes, BUCKETS))
    order = np.random.default_rng(8)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            at, values = rows[r]
            zs, ns = z[:, at], n[:, at]
            w = _proximal(zs, ns, alpha, beta, l1, l2)
            p = _softmax(w @ values)
            p[labels[r]] -= 1
            g = p[:, None] * values
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha
            z[:, at] = zs + g - sigma * w
            n[:, at] = ns + g * g
    return _proximal(z, n, alpha, beta, l1, l2)


def _proximal(z, n, alpha, beta, l1, l2):
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
    return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        p = _softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def predict(self, text: str) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 without letters or without a model."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        at, counts = ngrams(text)
        p = _softmax(self.weights[:, at] @ weighted(at, counts, self.idf) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(min(1.0, p[best]))


def held_out(key: str = "doc_id") -> Column:
    """A third of the documents by the hash of their id; without id, none."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def _document_frequencies(training: DataFrame) -> tuple[int, np.ndarray]:
    """How many of all training documents have each bucket."""
    def count(batches):
        total, docs = np.zeros(BUCKETS, np.int64), 0
        for batch in slices(batches, "body"):
            for body in texts_of(batch, "body"):
                total[ngrams(body)[0]] += 1
                docs += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": np.append(at, -1), "n": np.append(total[at], docs)})

    sums = training.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n"))
    found = dict(sums.collect())  # at most BUCKETS + 1 rows
    frequencies = np.zeros(BUCKETS)
    for bucket, n in found.items():
        if bucket >= 0:
            frequencies[bucket] = n
    return int(found.get(-1, 0)), frequencies


def train(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
          per_language: int = SAMPLE_PER_LANGUAGE, most: int = SAMPLE_DOCS) -> Model:
    """Learns from documents with text and label that are not held out. ``per_language`` whole documents of each
    language, or an equal share of ``most`` if that is less, go to the learner: those with the least hash, each text
    once a language however often it is repeated. Document frequencies come from all rows. Without any such document
    every prediction is ``und``."""
    training = docs.filter(~held_out(key)).select(
        F.col(text).alias("body"), F.col(label).alias("label")
    ).filter(F.col("body").isNotNull() & F.col("label").isNotNull())
    digest = F.xxhash64("body")
    texts = dict(training.groupBy("label").agg(F.approx_count_distinct(digest)).collect())
    languages = sorted(texts)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((0, BUCKETS)))
    n, frequencies = _document_frequencies(training.select("body"))
    idf = np.log((1 + n) / (1 + frequencies)) + 1

    share = max(1, min(per_language, most // len(languages)))
    rates = F.create_map(*(F.lit(x) for c in languages for x in (c, min(1.0, 2 * share / max(1, texts[c])))))
    drawn = training.withColumn("digest", digest).filter(
        F.pmod("digest", F.lit(1 << 30)) < rates[F.col("label")] * (1 << 30))

    def featured(batches):
        seen = set()  # of a sample, so small; copies in other tasks are dropped below
        for batch in slices(batches, "body"):
            keys = list(zip(batch.column("label").to_pylist(), batch.column("digest").to_pylist()))
            rows = []
            for key, body in zip(keys, texts_of(batch, "body")):
                if key not in seen:
                    seen.add(key)
                    rows.append((*key, *(a.astype(np.int32) for a in ngrams(body))))
            yield pa.RecordBatch.from_arrays([
                pa.array(column, kind) for column, kind in zip(
                    zip(*rows) if rows else [()] * 4,
                    (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                ["label", "digest", "at", "counts"])

    sample = drawn.mapInArrow(featured, "label string, digest bigint, at array<int>, counts array<int>")
    # the low bits of the hash, which the draw is by, order it too
    nth = F.row_number().over(Window.partitionBy("label").orderBy(F.pmod("digest", F.lit(1 << 30)), "digest"))
    sample = sample.dropDuplicates(["label", "digest"]).withColumn("nth", nth).filter(F.col("nth") <= share)
    got = sample.select("label", "at", "counts").toArrow()
    rows = []
    for at, counts in zip(got["at"], got["counts"]):
        at = at.values.to_numpy()
        rows.append((at, weighted(at, counts.values.to_numpy(), idf)))
    labels = np.array([languages.index(x) for x in got["label"].to_pylist()], np.int64)
    order = np.lexsort(([float(v.sum()) for _, v in rows], [len(a) for a, _ in rows], labels))
    rows, labels = [rows[i] for i in order], labels[order]
    aside = np.arange(len(rows)) % 5 == 4
    learned = [r for r, a in zip(rows, aside) if not a]
    weights = fit(learned, labels[~aside], len(languages))
    scores = np.array([weights[:, at] @ v for (at, v), a in zip(rows, aside) if a])
    del got, rows, learned
    give_back_memory()
    return Model(languages, idf, weights, temperature(scores, labels[aside]))


def _predicted(model: Model, bodies: list[str]) -> tuple[pa.Array, pa.Array]:
    got = [model.predict(b) for b in bodies]
    return pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row."""
    def run(batches):
        for batch in slices(batches, "body"):
            arrays = [batch.column("doc"), batch.column("held"), *_predicted(model, texts_of(batch, "body"))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    slim = docs.select(F.col(key).cast("bigint").alias("doc"), held_out(key).alias("held"),
                       F.col(text).alias("body"))
    return slim.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, text: str = "text", least: float = MIN_SCORE) -> DataFrame:
    """Rows whose language is recognised with a probability of ``least`` or more, as they are."""
    def run(batches):
        for batch in slices(batches, text):
            found, score = _predicted(model, texts_of(batch, text))
            known = pa.compute.and_(pa.compute.not_equal(found, UNKNOWN), pa.compute.greater_equal(score, least))
            yield batch.filter(known)

    return docs.mapInArrow(run, docs.schema)
