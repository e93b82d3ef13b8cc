"""Approximate nearest neighbours by inner product, on balanced posting lists.

Centroids come from a bounded sample; clusters of it that are too large are split, so that lists
are of like size. All vectors are indexed: each goes to its nearest centroid's list and, near a
boundary, to those of further centroids that are almost as near. Centroids are found by a best-first
walk over a graph of them that fits into memory. A query takes the lists whose centroids are within
a ratio of the nearest one's distance; the ratio is fitted so that enough of the true neighbours
of some sampled queries, found by brute force over all rows, lie in the lists it takes.

For the walk, rows get one more component, so that all have the length of the longest. Queries are brought to that
length as they are and get a zero there: the nearest by distance are then those with the largest inner product. How many
lists a query may take follows from the ratio and the sampled queries, up to all lists. A query that finds too few
rows takes all lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from novalake.llm.common import staged

SAMPLE = 20_000
SAMPLE_FLOATS = 1 << 24
LISTS_SHARE = 0.25  # lists wanted: the square root of so many times the rows
MOST_LISTS = 4_096
DEGREE = 16
REPLICAS, NEAR = 4, 1.1
LEAST_PROBES = 8
FIT_QUERIES = 96
FIT_RECALL = 0.96
PART_ROWS, PART_QUERIES = 4_096, 4_096


def usable(vector: Column) -> Column:
    """Not null, not zero, only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float32) for v in column]) if len(column) else np.zeros((0, 0), np.float32)


def _means(x: np.ndarray, k: int, rounds: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centers = x[np.sort(random.choice(len(x), k, replace=False))].copy()
    for _ in range(rounds):
        label = np.argmin((centers**2).sum(1) - 2 * x @ centers.T, axis=1)
        order = np.argsort(label, kind="stable")
        used, starts = np.unique(label[order], return_index=True)
        centers[used] = np.add.reduceat(x[order], starts, axis=0) / np.diff(np.append(starts, len(x)))[:, None]
    return centers, np.argmin((centers**2).sum(1) - 2 * x @ centers.T, axis=1)


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """About ``lists`` means; a cluster of over twice the mean size is split in two until none is."""
    random = np.random.default_rng(6)
    centers, label = _means(x, min(lists, len(x)), 8, random)
    open_ = [x[label == n] for n in range(len(centers))]
    limit, out = max(2, 2 * len(x) // max(1, lists)), []
    while open_:
        part = open_.pop()
        if len(part) > limit:
            _, half = _means(part, 2, 4, random)
            if 0 < half.sum() < len(part):
                open_ += [part[half == 0], part[half == 1]]
                continue
        if len(part):
            out.append(part.mean(0))
    return np.array(out, np.float32)


@dataclass
class CentroidGraph:
    """Centroids, each joined to its nearest ones and, so that all can be reached, to the next."""

    centers: np.ndarray
    edges: np.ndarray
    longest: float

    @classmethod
    def of(cls, centers: np.ndarray, longest: float) -> CentroidGraph:
        norms = (centers**2).sum(1)
        degree = min(DEGREE, max(1, len(centers) - 1))
        edges = np.zeros((len(centers), degree + 1), np.int64)
        for start in range(0, len(centers), 512):
            block = slice(start, start + 512)
            apart = norms - 2 * centers[block] @ centers.T
            apart[np.arange(len(apart)), np.arange(len(apart)) + start] = np.inf
            edges[block, :degree] = np.argsort(apart, axis=1, kind="stable")[:, :degree]
        own = np.arange(len(centers))
        following = (own + 1) % len(centers)
        edges[:, degree] = np.where((edges[:, :degree] == following[:, None]).any(axis=1), own, following)
        return cls(centers, edges, longest)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """One more component: what is missing to the length of the longest vector."""
        rest = np.sqrt(np.maximum(self.longest**2 - (x.astype(np.float64) ** 2).sum(1), 0))
        return np.hstack([x, rest[:, None].astype(np.float32)])

    def aimed(self, x: np.ndarray) -> np.ndarray:
        """Queries among the lifted rows: as long as the longest, with nothing in the last component."""
        lengths = np.sqrt((x.astype(np.float64) ** 2).sum(1, keepdims=True))
        return np.hstack([(x * (self.longest / lengths)).astype(np.float32), np.zeros((len(x), 1), np.float32)])

    def all_apart(self, points: np.ndarray) -> np.ndarray:
        """Distances of points to all centroids."""
        square = (points**2).sum(1)[:, None] + (self.centers**2).sum(1) - 2 * points @ self.centers.T
        return np.sqrt(np.maximum(square, 0))

    def walk(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids met by a best-first walk, and their distances, for many
        points at once; a column holds one point's step."""
        n, k = len(points), len(self.centers)
        width = min(width, k)
        rows = np.arange(n)
        entries = np.linspace(0, k - 1, min(k, 8)).astype(np.int64)
        at = np.full((n, width + len(entries)), -1)
        apart = np.full(at.shape, np.inf, np.float32)
        seen, done = np.zeros((n, k), bool), np.zeros(at.shape, bool)
        at[:, :len(entries)] = entries
        apart[:, :len(entries)] = self._apart(points, np.broadcast_to(entries, (n, len(entries))))
        seen[:, entries] = True
        order = np.argsort(apart, axis=1, kind="stable")[:, :width]
        at, apart, done = (np.take_along_axis(a, order, 1) for a in (at, apart, done))
        while True:
            waiting = np.where(done | (at < 0), np.inf, apart)
            best = np.argmin(waiting, axis=1)
            open_ = rows[np.isfinite(waiting[rows, best])]
            if not len(open_):
                return at, np.sqrt(np.maximum(apart, 0))
            node = at[open_, best[open_]]
            done[open_, best[open_]] = True
            near = self.edges[node]
            new = ~seen[open_[:, None], near]
            seen[open_[:, None], near] = True
            far = np.where(new, self._apart(points[open_], near), np.inf)
            near = np.where(new, near, -1)
            all_at, all_apart = np.hstack([at[open_], near]), np.hstack([apart[open_], far])
            all_done = np.hstack([done[open_], np.zeros(near.shape, bool)])
            order = np.argsort(all_apart, axis=1, kind="stable")[:, :width]
            at[open_], apart[open_], done[open_] = (
                np.take_along_axis(a, order, 1) for a in (all_at, all_apart, all_done))

    def _apart(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        difference = self.centers[nodes] - points[:, None, :]
        return np.einsum("ijk,ijk->ij", difference, difference)

    def lists(self, x: np.ndarray, width: int, ratio: float, least: int = 1,
              asks: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: of the ``width`` nearest centroids those within ``ratio`` of the nearest one's distance,
        ``least`` at least. A walk that is to find a quarter of all centroids would meet all of them: then they
        are compared one by one."""
        parts = []
        for start in range(0, len(x), 512):
            points = self.aimed(x[start : start + 512]) if asks else self.lifted(x[start : start + 512])
            if 4 * width >= len(self.centers):
                apart = self.all_apart(points)
                at = np.argsort(apart, axis=1, kind="stable")[:, :width]
                apart = np.take_along_axis(apart, at, 1)
            else:
                at, apart = self.walk(points, width)
            take = (at >= 0) & ((apart <= ratio * apart[:, :1]) | (np.arange(at.shape[1]) < least) | np.isinf(ratio))
            row, column = np.nonzero(take)
            parts.append(np.stack((row + start, at[row, column])))
        both = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
        return both[0], both[1]


def best(scores: np.ndarray, count: int) -> np.ndarray:
    """Columns of the ``count`` largest in each row, and any that tie with the last of them."""
    if scores.shape[1] <= count:
        return np.ones(scores.shape, bool)
    least = -np.partition(-scores, count - 1, axis=1)[:, count - 1 : count]
    return scores >= least


def _ranked(ids: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    once = np.sort(np.unique(ids, return_index=True)[1])[:count]
    return ids[once], scores[once]


FOUND = "query_id bigint, ids array<bigint>, scores array<double>"


def _search(queries: np.ndarray, query_ids, vectors: np.ndarray, members, count: int):
    """For each query its best rows: (query, ids, scores). A row stands for all ids of its vector."""
    vectors = vectors.astype(np.float64)
    for start in range(0, len(queries), 256):
        scores = queries[start : start + 256].astype(np.float64) @ vectors.T
        taken = best(scores, count + 1)
        for n, query in enumerate(query_ids[start : start + 256]):
            rows = np.flatnonzero(taken[n])
            ids = [members[r] for r in rows]
            of = np.repeat(scores[n][rows], [len(m) for m in ids])
            ids = np.concatenate(ids)
            other = ids != query
            yield query, *_ranked(ids[other], of[other], count)


def _nearest_in_list(count: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asked):
            members = [np.asarray(m, np.int64) for m in rows["members"]]
            found = list(_search(matrix(asked["vector"]), asked["vec_id"].tolist(), matrix(rows["vector"]),
                                 members, count))
        return pd.DataFrame(found, columns=["query_id", "ids", "scores"])
    return run


def _merge(count: int):
    def run(found: pd.DataFrame) -> pd.DataFrame:
        ids, scores = _ranked(np.concatenate(found["ids"].to_list()), np.concatenate(found["scores"].to_list()), count)
        return pd.DataFrame({"query_id": found["query_id"].iloc[0], "rank": np.arange(1, len(ids) + 1, dtype=np.int32),
                             "vec_id": ids, "score": scores})
    return run


def distinct_vectors(vectors: DataFrame, count: int) -> DataFrame:
    """``members, vector``: each distinct vector with its ``count + 1`` least ids: more of equal
    vectors can never be among a query's nearest. The least are chosen before the shuffle too."""
    numbered = vectors.selectExpr("vec_id", "vector",
                                  "row_number() over (partition by vector order by vec_id) as nth")
    return numbered.filter(F.col("nth") <= count + 1).groupBy("vector").agg(
        F.sort_array(F.collect_list("vec_id")).alias("members"))


def _in_lists(rows: DataFrame, graph, width: int, ratio: float, least: int = 1, asks: bool = False) -> DataFrame:
    """Adds ``list`` to rows with ``vector``, one row for each list."""
    schema = StructType([*rows.schema.fields, StructField("list", IntegerType())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                row, found = graph.value.lists(matrix(part.column("vector").to_pylist()), width, ratio, least, asks)
                yield part.take(pa.array(row)).append_column("list", pa.array(found, pa.int32()))

    return rows.mapInArrow(run, schema)


def _true_neighbours(rows: DataFrame, queries: pd.DataFrame, count: int) -> dict[int, np.ndarray]:
    """Vectors of the true nearest of a few queries, by brute force over all rows in blocks."""
    ids, asked = queries["vec_id"].tolist(), matrix(queries["vector"])

    def run(batches):
        for batch in batches:
            vectors, members = batch.column("vector").to_pylist(), batch.column("members").to_pylist()
            scores = asked.astype(np.float64) @ matrix(vectors).astype(np.float64).T
            for n, r in zip(*np.nonzero(best(scores, count + 1))):
                if members[r] != [ids[n]]:
                    yield pa.RecordBatch.from_pylist(
                        [{"query_id": ids[n], "score": scores[n, r], "vector": vectors[r]}], schema)

    schema = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("vector", pa.list_(pa.float32()))])
    near = rows.mapInArrow(run, "query_id bigint, score double, vector array<float>")
    near = near.selectExpr("*", "row_number() over (partition by query_id order by score desc) as nth")
    got = near.filter(F.col("nth") <= count).toPandas()  # FIT_QUERIES * count rows
    return {q: matrix(part["vector"]) for q, part in got.groupby("query_id")}


def fit_ratio(graph: CentroidGraph, queries: pd.DataFrame, near: dict[int, np.ndarray]) -> tuple[float, int]:
    """The ratio for which ``FIT_RECALL`` of the true neighbours lie in a list that is taken; and twice the most lists that
    one of the queries takes by it."""
    needed, ratios = [], []
    for query, vector in zip(queries["vec_id"], queries["vector"]):
        if query not in near:
            continue
        apart = graph.all_apart(graph.aimed(matrix([vector])))[0]
        ratio = apart / max(float(apart.min()), 1e-12)
        row, found = graph.lists(near[query], REPLICAS, NEAR)
        least = np.full(len(near[query]), np.inf)
        np.minimum.at(least, row, ratio[found])
        needed.append(least)
        ratios.append(ratio)
    if not needed:
        return np.inf, len(graph.centers)
    needed = np.sort(np.concatenate(needed))
    wanted = float(needed[min(len(needed) - 1, int(np.ceil(FIT_RECALL * len(needed))))]) * (1 + 1e-5)
    most = max(int((r <= wanted).sum()) for r in ratios)
    return wanted, min(len(graph.centers), max(LEAST_PROBES, 2 * most))


def nearest(vectors: DataFrame, is_query: Column, count: int, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row its ``count`` nearest other rows found.

    Vectors that are null, zero or hold a null or non-finite component, rows without id, and vectors
    of another than the commonest length take no part. Repeated ids count as one row per distinct
    vector. With fewer rows than ``count``, all are returned.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"),
                          F.col(vector).cast("array<float>").alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("vector") == sizes["size"])
    distinct = staged(distinct_vectors(rows.select("vec_id", "vector"), count), "distinct-vectors")
    queries = staged(rows.filter("asks").select("vec_id", "vector"), "query-vectors")

    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    n, longest = distinct.agg(F.count("*"), F.max(F.sqrt(squares))).first()
    wanted = min(SAMPLE, SAMPLE_FLOATS // sizes["size"])
    drawn = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < F.lit(int(min(1.0, wanted / n) * (1 << 30)))
    sample = distinct.filter(drawn | F.lit(n <= wanted)).select("vector").limit(wanted).toPandas()
    base = CentroidGraph(np.zeros((0, 0)), np.zeros((0, 0)), longest)
    points = base.lifted(matrix(sample["vector"]))
    points = points[np.lexsort(points.T)]
    wanted = min(MOST_LISTS, round((n * LISTS_SHARE) ** 0.5), len(points))
    graph = CentroidGraph.of(balanced_centroids(points, max(1, wanted)), longest)

    few = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_QUERIES).toPandas()
    ratio, probes = fit_ratio(graph, few, _true_neighbours(distinct, few, count))

    shared = spark.sparkContext.broadcast(graph)  # a centroid for each list, of at most SAMPLE vectors
    indexed = staged(_in_lists(distinct, shared, REPLICAS, NEAR), "posting-lists")
    found = staged(_searched(indexed, _in_lists(queries, shared, probes, ratio, LEAST_PROBES, asks=True), count), "neighbours")
    reached = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= min(count, n - 1))
    short = queries.join(reached, F.col("vec_id") == F.col("query_id"), "left_anti")
    if n > 1 and not short.isEmpty():  # as many as there are must be found: look into all lists
        again = _searched(indexed, _in_lists(short, shared, len(graph.centers), float("inf"), asks=True), count)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")


def _searched(indexed: DataFrame, asked: DataFrame, count: int) -> DataFrame:
    """Every list with the queries that take it, in parts of bounded size; then each query's best."""
    asked = staged(asked, "posting-queries")
    parts = _parts(indexed, PART_ROWS, "row_parts").join(_parts(asked, PART_QUERIES, "query_parts"), "list")
    parts = F.broadcast(parts)  # a row for each list
    by_row = indexed.join(parts, "list").select(
        "list", "members", "vector", F.pmod(F.xxhash64("vector"), "row_parts").alias("row_part"),
        F.explode(F.expr("sequence(0, query_parts - 1)")).alias("query_part"))
    by_query = asked.join(parts, "list").select(
        "list", "vec_id", "vector", F.pmod(F.xxhash64("vec_id"), "query_parts").cast("int").alias("query_part"),
        F.explode(F.expr("sequence(0L, cast(row_parts - 1 as bigint))")).alias("row_part"))
    keys = ["list", "row_part", "query_part"]
    found = by_row.groupBy(*keys).cogroup(by_query.groupBy(*keys)).applyInPandas(_nearest_in_list(count), FOUND)
    return found.groupBy("query_id").applyInPandas(
        _merge(count), "query_id bigint, rank int, vec_id bigint, score double")


def _parts(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Into how many parts a list's rows are dealt, so that none has many more than ``size``."""
    return rows.groupBy("list").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
