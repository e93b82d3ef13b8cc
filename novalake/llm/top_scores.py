"""Exact top-k search by inner product of integer vectors, by distributed histogram selection.

Every query meets every row, in blocks: a task holds one block of queries and one slab of rows. A
score is read as a non-negative number of so many bits, and its digits are settled from the highest:
a round counts, for each query, the next digit of all scores that agree with the digits settled
so far; sums over all slabs tell which digit the k-th score has. When all digits are known, a last pass
keeps the scores above the k-th and, of those equal to it, the ones first by id: slabs are ranges of the
ids, so that counts for each slab say how many equal ones it may give.

A slab sends only its highest counted digits, down to where it has as many rows as are still wanted:
the k-th score of all rows is no lower than that of some. So a query gets at most k counts from a slab,
and at the end exactly k rows, whatever the ties.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from novalake.llm.common import staged

SCALE = 64
SLAB_FLOATS, QUERY_FLOATS = 1 << 21, 1 << 18
DIGIT_BITS = 10
CHUNK_ROWS, CHUNK_QUERIES = 8_192, 128
EXACT = float(1 << 53)
LONGEST = (1 << 63) - 1

COUNTS = "query bigint, slab bigint, digit int, n bigint"
FOUND = "query bigint, place bigint, score bigint"


def integers(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    """Rows of floor(scale * x), as exact doubles; shorter vectors end in zeros."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), max(1, int(lengths.max(initial=0)))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return np.floor(out * scale)


def _padded(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


def products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products as longs: by doubles where all their sums are exact, else by whole numbers of any
    size; what no long can hold becomes the largest or smallest one."""
    apart = np.outer(np.linalg.norm(rows, axis=1), np.linalg.norm(queries, axis=1))
    if apart.max(initial=0) < EXACT:
        return (rows @ queries.T).astype(np.int64)
    out = np.zeros(apart.shape, np.int64)
    fine = apart < EXACT
    out[fine] = (rows @ queries.T)[fine].astype(np.int64)
    for r, q in np.argwhere(~fine):
        total = sum(int(a) * int(b) for a, b in zip(rows[r], queries[q]))
        out[r, q] = max(-LONGEST, min(LONGEST, total))
    return out


def _blocks(queries: pa.Table, rows: pa.Table, bits: int, scale: float):
    """``(queries, rows, keys, own)`` piece by piece: positions, scores as unsigned numbers (shifted up by
    2 ** bits), and which pairs are a row with itself. Rows come in the order of their places."""
    rows = rows.sort_by("place")
    asked, have = integers(queries["vector"], scale), integers(rows["vector"], scale)
    width = max(asked.shape[1], have.shape[1])
    asked, have = _padded(asked, width), _padded(have, width)
    asks, places = queries["query"].to_numpy(), rows["place"].to_numpy()
    for q in range(0, len(asked), CHUNK_QUERIES):
        qs = slice(q, min(len(asked), q + CHUNK_QUERIES))
        for r in range(0, len(have), CHUNK_ROWS):
            rs = slice(r, min(len(have), r + CHUNK_ROWS))
            keys = products(have[rs], asked[qs]).view(np.uint64) + np.uint64(1 << bits)
            yield qs, rs, keys, places[rs, None] == asks[qs]


def _count_digits(shift: int, digits: int, bits: int, scale: float):
    """Counts of the digit of ``digits`` bits at ``shift`` among the keys that begin with the settled ones."""
    def count(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {n: [] for n in ("query", "slab", "digit", "n")}
        if queries.num_rows and rows.num_rows:
            size, top = 1 << digits, shift + digits
            counts = np.zeros((queries.num_rows, size), np.int64)
            settled = queries["settled"].to_numpy().view(np.uint64)
            for qs, _, keys, own in _blocks(queries, rows, bits, scale):
                at = np.broadcast_to(np.arange(keys.shape[1]) * size, keys.shape)
                digit = ((keys >> np.uint64(shift)) & np.uint64(size - 1)).astype(np.int64)
                fit = ~own if top > bits else ((keys >> np.uint64(top)) == settled[qs]) & ~own
                found = np.bincount((at + digit)[fit], minlength=keys.shape[1] * size)
                counts[qs] += found.reshape(-1, size)
            wanted = queries["wanted"].to_numpy()
            above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            at, digit = np.nonzero((counts > 0) & (above < wanted[:, None]))
            out = {"query": queries["query"].to_numpy()[at], "slab": np.full(len(at), rows["slab"][0].as_py()),
                   "digit": digit.astype(np.int32), "n": counts[at, digit]}
        return pa.table(out, schema=pa.schema([("query", pa.int64()), ("slab", pa.int64()),
                                               ("digit", pa.int32()), ("n", pa.int64())]))

    return count


def _keep(bits: int, scale: float):
    """The rows above the k-th key, and as many of those equal to it as the slab may give."""
    def keep(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query": [np.zeros(0, np.int64)], "place": [np.zeros(0, np.int64)], "score": [np.zeros(0, np.int64)]}
        if queries.num_rows and rows.num_rows:
            least, left = queries["settled"].to_numpy().view(np.uint64), queries["quota"].to_numpy().copy()
            asks, places = queries["query"].to_numpy(), np.sort(rows["place"].to_numpy())
            for qs, rs, keys, own in _blocks(queries, rows, bits, scale):
                same = (keys == least[qs]) & ~own
                nth = np.cumsum(same, axis=0)
                r, q = np.nonzero(((keys > least[qs]) & ~own) | (same & (nth <= left[qs])))
                left[qs] -= np.minimum(left[qs], nth[-1])
                out["query"].append(asks[qs][q])
                out["place"].append(places[rs][r])
                out["score"].append((keys[r, q] - np.uint64(1 << bits)).view(np.int64))
        return pa.table({n: np.concatenate(v) for n, v in out.items()})

    return keep


def top_scores(vectors: DataFrame, is_query: Column, count: int, key: str = "vec_id",
               vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` holds, the ``count`` other rows
    with the highest inner product of floor(``scale`` * x), ties to the smaller id.

    Vectors that are null or hold a null or non-finite component take no part. An empty vector scores 0
    with all, and of two lengths the shorter counts as ending in zeros. A row without id is a candidate,
    behind all others in ties, and never a query unless ``is_query`` says so. Rows that repeat an id, or
    id and vector, are rows of their own: each is a candidate and, as a query, gets its own ``count`` rows under the
    same ``query_id`` (ranks then repeat); ties between them go by their place in the table. With fewer other
    rows than ``count``, all are returned; an empty table gives none. Scores that no long can hold are
    given, and compared, as the largest or smallest long.
    """
    spark = vectors.sparkSession
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"),
    ).filter(F.col("vector").isNotNull() & usable)
    rows = staged(rows, "vectors")
    reach = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1))
    n, asking, width, longest = rows.agg(
        F.count("*"), F.count_if("asks"), F.max(F.size("vector")), F.max(reach)).first()
    if n < 2 or not asking:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    count, width = min(count, n - 1), max(1, width)
    bits = min(63, max(1, math.ceil(math.log2(longest + 1)))) if math.isfinite(longest) else 63

    by_id = [F.col("vec_id").asc_nulls_last(), F.col("row")]
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-n * width // SLAB_FLOATS))
    slabs = staged(rows.repartitionByRange(parts, *by_id).sortWithinPartitions(*by_id)
                   .withColumn("place", F.monotonically_increasing_id()), "slabs")
    slabs = slabs.withColumn("slab", F.shiftright("place", 33))
    blocks = -(-asking * width // QUERY_FLOATS)
    last = slabs.agg(F.max("slab")).first()[0]
    asked = slabs.filter("asks").select(
        F.col("place").alias("query"), F.col("vector").alias("vector"), F.pmod(F.xxhash64("place"), F.lit(blocks)).alias("block"))
    have = slabs.select("place", "vector", "slab", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast(
        "array<bigint>")).alias("block"))
    each_slab = F.explode(F.sequence(F.lit(0), F.lit(last)).cast("array<bigint>")).alias("slab")

    def met(state: DataFrame, function, schema: str, *joined: DataFrame) -> DataFrame:
        queries = asked.join(state, "query").select("*", each_slab)
        for other in joined:
            queries = queries.join(other, ["query", "slab"], "left")
        if joined:
            queries = queries.fillna(0, ["quota"])
        pairs = queries.groupBy("block", "slab").cogroup(have.groupBy("block", "slab"))
        return pairs.applyInArrow(function, schema)

    rounds = -(-(bits + 1) // DIGIT_BITS)
    digits = [(bits + 1) // rounds + (i < (bits + 1) % rounds) for i in range(rounds)]
    state = asked.select("query", F.lit(0).cast("bigint").alias("settled"), F.lit(count).alias("wanted"))
    shift = bits + 1
    for size in digits:
        shift -= size
        counts = staged(met(state, _count_digits(shift, size, bits, scale), COUNTS), "digit-counts")
        highest = Window.partitionBy("query").orderBy(F.desc("digit"))
        summed = counts.groupBy("query", "digit").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(highest))
        hit = summed.join(state, "query").filter("upto >= wanted and upto - n < wanted")
        state = staged(hit.select(
            "query", F.expr(f"shiftleft(settled, {size}) | cast(digit as bigint)").alias("settled"),
            (F.col("wanted") - F.col("upto") + F.col("n")).alias("wanted"), "digit"), "settled-digits")
        ties = counts.join(state, ["query", "digit"]).select("query", "slab", "n", "wanted")
        state = state.drop("digit")

    by_slab = Window.partitionBy("query").orderBy("slab")
    first = ties.withColumn("nth", F.row_number().over(by_slab)).filter(F.col("nth") <= count)
    before = F.sum("n").over(by_slab) - F.col("n")
    quota = first.select("query", "slab", F.greatest(F.lit(0), F.least("n", F.col("wanted") - before)).alias("quota"))
    kept = staged(met(state, _keep(bits, scale), FOUND, quota), "top-scores")
    named = slabs.select("place", "vec_id")
    kept = kept.join(named, "place").join(named.select(F.col("place").alias("query"), F.col("vec_id").alias(
        "query_id")), "query")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "place")
    return kept.select("query_id", F.row_number().over(best).cast("int").alias("rank"), "vec_id", "score")
