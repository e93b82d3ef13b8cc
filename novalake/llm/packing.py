"""Best-fit packing of token sequences, with large items matched first.

Pieces longer than a third of the capacity share a sequence with at most one other such piece, so
they are matched in pairs: the longest free one with the longest that still fits beside it. Shorter
pieces go, longest first, into the smallest gap that takes them; only when none does, a new sequence
is opened. Pieces of one length are alike, so the plan is made on the count of each length (at most
``capacity`` numbers, however large the corpus) and consists of runs: "these ranks of this length go
to these sequences at this offset". Spark ranks the pieces within their length, and looks each one
up in the runs.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from novalake.llm.common import slices, staged, texts_of
from novalake.llm.tokens import encoder

CAPACITY = 4096
END_ID = 1
RUN_FIELDS = ("first", "stop", "sequence", "each", "offset")
# A length meets each gap class at most once, so the runs number less than capacity squared; far
# fewer come up. Beyond this many they are joined instead of broadcast.
BROADCAST_RUNS = 1 << 18

PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "rank_in_part bigint")


class Plan:
    """Runs of equal lengths; ``runs[length]`` has (first rank, stop rank, first sequence,
    pieces in each sequence, offset of the first piece)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
        self.placed: Counter[int] = Counter()
        self.sequences = 0
        self.gaps: list[int] = []
        self.holes: dict[int, list[tuple[int, int]]] = {}

    def _put(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        first = self.placed[length]
        self.runs[length].append((first, first + count, sequence, each, offset))
        self.placed[length] += count

    def _open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def _leave(self, gap: int, sequence: int, count: int) -> None:
        if gap and count:
            if gap not in self.holes:
                insort(self.gaps, gap)
                self.holes[gap] = []
            self.holes[gap].append((sequence, count))

    def match_large(self, counts: Counter[int]) -> None:
        """Pairs the pieces above a third of the capacity; full ones stay alone."""
        lengths = sorted(n for n in counts if 3 * n > self.capacity)
        free = Counter({n: counts[n] for n in lengths})
        while lengths:
            long = lengths[-1]
            at = bisect_left(lengths, self.capacity - long + 1) - 1
            if at < 0:
                lengths.pop()
                first = self._open(free[long])
                self._put(long, free[long], first, 1, 0)
                self._leave(self.capacity - long, first, free[long])
                continue
            short = lengths[at]
            pairs = free[long] // 2 if short == long else min(free[long], free[short])
            if short == long and not pairs:  # one is left, and no shorter one fits better
                lengths.pop()
                partner = lengths[-1] if lengths else None
                first = self._open(1)
                self._put(long, 1, first, 1, 0)
                if partner is None:
                    self._leave(self.capacity - long, first, 1)
                else:
                    self._put(partner, 1, first, 1, long)
                    self._leave(self.capacity - long - partner, first, 1)
                    free[partner] -= 1
                    if not free[partner]:
                        lengths.pop()
                continue
            first = self._open(pairs)
            self._put(long, pairs, first, 1, 0)
            self._put(short, pairs, first, 1, long)
            self._leave(self.capacity - long - short, first, pairs)
            for length in {long, short}:
                free[length] -= 2 * pairs if long == short else pairs
                if not free[length]:
                    lengths.remove(length)

    def fit_small(self, counts: Counter[int]) -> None:
        """Best fit, longest first, of the pieces up to a third of the capacity."""
        for length in sorted((n for n in counts if 3 * n <= self.capacity), reverse=True):
            left = counts[length]
            while left:
                at = bisect_left(self.gaps, length)
                if at == len(self.gaps):
                    each = self.capacity // length
                    full, rest = divmod(left, each)
                    if full:
                        first = self._open(full)
                        self._put(length, full * each, first, each, 0)
                        self._leave(self.capacity - each * length, first, full)
                    if rest:
                        first = self._open(1)
                        self._put(length, rest, first, rest, 0)
                        self._leave(self.capacity - rest * length, first, 1)
                    break
                gap = self.gaps[at]
                sequence, count = self.holes[gap].pop()
                if not self.holes[gap]:
                    del self.holes[gap]
                    self.gaps.pop(at)
                each = gap // length
                full = min(count, left // each)
                offset = self.capacity - gap
                if full:
                    self._put(length, full * each, sequence, each, offset)
                    self._leave(gap - each * length, sequence, full)
                    left -= full * each
                if full < count:
                    if left:  # fewer than fill one gap
                        self._put(length, left, sequence + full, left, offset)
                        self._leave(gap - left * length, sequence + full, 1)
                        full, left = full + 1, 0
                    self._leave(gap, sequence + full, count - full)


def plan(counts: Counter[int], capacity: int) -> Plan:
    made = Plan(capacity)
    made.match_large(counts)
    made.fit_small(counts)
    return made


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           text: str = "text", key: str = "doc_id") -> DataFrame:
    """Cuts each document's ids, with the end id, into pieces of at most ``capacity``.

    Besides the piece: ``part``, the task that made it, and ``rank_in_part``, its rank among that
    task's pieces of the same length. A null or empty text is the end id alone.
    """
    def cut(batches):
        encode = encoder(tokenizer)
        ranks: Counter[int] = Counter()
        for batch in slices(batches, "body"):
            rows = []
            for doc, body in zip(batch.column("doc").to_pylist(), texts_of(batch, "body")):
                ids = np.frombuffer(encode.encode(body), encode.width)
                ids = np.append(ids, end_id).astype("<u4")
                for n, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc, n, start, len(part), zlib.crc32(part), ranks[len(part)]))
                    ranks[len(part)] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), PIECE_TYPES)], PIECE_NAMES)

    slim = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("body"))
    made = slim.mapInArrow(cut, PIECES)
    return staged(made.withColumn("part", F.spark_partition_id()), "pieces")


PIECE_NAMES = [x.split()[0] for x in PIECES.split(", ")]
PIECE_TYPES = [pa.int32() if x.endswith(" int") else pa.int64() for x in PIECES.split(", ")]


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have ``length``, ``part`` and
    ``rank_in_part``. An empty table gives no rows."""
    spark = cut.sparkSession
    per_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    per_part = staged(per_part, "piece-counts")
    counts = Counter({n: c for n, c in per_part.groupBy("length").agg(F.sum("n")).collect()})
    made = plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("rank_in_part"))
    return _placed(spark, ranked, made)


def _placed(spark: SparkSession, ranked: DataFrame, made: Plan) -> DataFrame:
    rows = [(length, *run) for length, runs in made.runs.items() for run in runs]
    runs = spark.createDataFrame(rows, "length bigint, first bigint, stop bigint, sequence bigint, "
                                       "each bigint, run_offset bigint")
    if len(rows) <= BROADCAST_RUNS:
        runs = F.broadcast(runs)
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop"))
    nth = F.col("rank") - F.col("first")
    placed = ranked.join(runs, "length").filter(inside)
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("run_offset") + nth % F.col("each") * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                   end_id: int = END_ID) -> DataFrame:
    """Packs whole documents into as few sequences as the matching finds."""
    return pack(pieces(docs, tokenizer, capacity, end_id), capacity)
