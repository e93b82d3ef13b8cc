"""Token ids in binary shards, with constant-time access by document key.

A store is a folder with two tables that Spark writes and reads like any others:

* ``payload``: shards in ascending key order. A row is a chunk of whole documents: their ids one
  after the other as raw little-endian integers, and beside them keys and lengths.
* ``index``: one row for each bucket of hashed keys, with a minimal perfect hash (levels of bit
  arrays; a key belongs to the first level where no other key met it, its rank among all set bits
  is its slot), and for each slot a 32-bit fingerprint of the key and the address: shard, number
  in the shard, chunk, byte offset. A key that is not in the store is told by its fingerprint.

A repeated key is one extent of neighbouring documents in each shard it reaches; ``more`` says
that the next extent has an entry of its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from novalake.llm.common import slices, texts_of
from novalake.llm.tokens import encoder

END_ID = 2
CHUNK_BYTES = 1 << 20
KEYS_PER_BUCKET = 50_000
NULL_KEY = -(1 << 63)
SPARE = 2  # bits for each key in a level
ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("nth", "<u8"), ("chunk", "<u4"),
                  ("offset", "<u8"), ("count", "<u8"), ("more", "u1")])

PAYLOAD = ("shard int, chunk int, first_nth bigint, ids_before bigint, keys array<bigint>, "
           "lengths array<bigint>, width int, ids binary")


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key: odd multiplications and shifts."""
    h = keys + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_key(keys: np.ndarray, extents: np.ndarray) -> np.ndarray:
    return mixed(keys.astype("<i8").view("<u8"), 1) ^ mixed(extents.astype("<u8"), 2)


class PerfectHash:
    """Maps n distinct 64-bit hashes to 0..n-1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ranks = [np.cumsum(bits, dtype=np.int64) for bits in levels]
        base = np.cumsum([0, *(int(r[-1]) for r in ranks)])
        self.ranks = [r - 1 + b for r, b in zip(ranks, base)]

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        levels, left = [], hashes
        while len(left):
            size = max(64, -(-SPARE * len(left) // 8) * 8)
            at = (mixed(left, 3 + len(levels)) % np.uint64(size)).astype(np.int64)
            met = np.bincount(at, minlength=size)
            levels.append(met == 1)
            left = left[met[at] > 1]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 where no level has it."""
        slots = np.full(len(hashes), -1, np.int64)
        for n, bits in enumerate(self.levels):
            at = (mixed(hashes, 3 + n) % np.uint64(len(bits))).astype(np.int64)
            hit = (slots < 0) & bits[at]
            slots[hit] = self.ranks[n][at[hit]]
        return slots

    def packed(self) -> tuple[list[int], bytes]:
        return [len(b) for b in self.levels], b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def unpacked(cls, sizes: list[int], data: bytes) -> PerfectHash:
        bits = np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)
        return cls(np.split(bits, np.cumsum(sizes)[:-1]) if len(sizes) else [])


def write_payload(docs: DataFrame, path: str, tokenizer: str, end_id: int, shards: int,
                  text: str = "text", key: str = "doc_id") -> None:
    """Encodes and writes all documents, sorted by key (a null key is the least long).

    Rows are dealt by ranges of the key and, within a repeated key, of their place in the input, so
    that no key is too big for a shard's task. A null text has the end id alone.
    """
    def encode_shard(batches):
        encode = encoder(tokenizer)
        shard = None
        keys, lengths, parts, held, chunk, nth, before = [], [], [], 0, 0, 0, 0

        def row():
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "chunk": chunk, "first_nth": nth, "ids_before": before, "keys": keys,
                "lengths": lengths, "width": encode.width.itemsize, "ids": b"".join(parts)}], schema)

        end = np.array([end_id], encode.width).tobytes()
        for batch in slices(batches, "body"):
            shard = batch.column("shard")[0].as_py()
            for doc, body in zip(batch.column("doc").to_pylist(), texts_of(batch, "body")):
                ids = encode.encode(body) + end
                keys.append(doc)
                lengths.append(len(ids) // encode.width.itemsize)
                parts.append(ids)
                held += len(ids)
                if held >= CHUNK_BYTES:
                    yield row()
                    chunk, nth, before = chunk + 1, nth + len(keys), before + sum(lengths)
                    keys, lengths, parts, held = [], [], [], 0
        if keys:
            yield row()

    schema = pa.schema([
        ("shard", pa.int32()), ("chunk", pa.int32()), ("first_nth", pa.int64()),
        ("ids_before", pa.int64()), ("keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("width", pa.int32()), ("ids", pa.binary())])
    slim = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_KEY)).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text).alias("body"),
    )
    ranged = slim.repartitionByRange(shards, "doc", "row").sortWithinPartitions("doc", "row")
    ranged = ranged.select("doc", "body", F.spark_partition_id().alias("shard"))
    ranged.mapInArrow(encode_shard, PAYLOAD).write.option("compression", "zstd").parquet(f"{path}/payload")


def payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYLOAD).parquet(f"{path}/payload")


def write_index(spark: SparkSession, path: str) -> None:
    """Builds the index from the payload's keys and lengths; the ids are not read."""
    heads = payload(spark, path).select("shard", "chunk", "first_nth", "width", "keys", "lengths")
    keys = heads.agg(F.sum(F.size("keys"))).first()[0] or 0
    buckets = max(1, -(-keys // KEYS_PER_BUCKET))

    def entries(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, lengths = np.array(r["keys"], np.int64), np.array(r["lengths"], np.int64)
                new = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
                offsets = (np.cumsum(lengths) - lengths)[new] * r["width"]
                yield pa.RecordBatch.from_pydict({
                    "key": ids[new], "shard": np.full(len(new), r["shard"], np.int32),
                    "nth": r["first_nth"] + new, "chunk": np.full(len(new), r["chunk"], np.int32),
                    "offset": offsets, "count": np.diff(np.append(new, len(ids)))})

    first = heads.mapInArrow(
        entries, "key bigint, shard int, nth bigint, chunk int, offset bigint, count bigint")
    extents = first.groupBy("key", "shard").agg(
        F.min(F.struct("nth", "chunk", "offset")).alias("at"), F.sum("count").alias("count"))
    order = Window.partitionBy("key").orderBy("shard")
    extents = extents.select(
        "key", "shard", "at.*", "count",
        (F.row_number().over(order) - 1).cast("bigint").alias("extent"),
        F.lead("shard").over(order).isNotNull().alias("more"),
    ).withColumn("bucket", _bucket(buckets))

    def build(table: pd.DataFrame) -> pd.DataFrame:
        hashes = hashed_key(table["key"].to_numpy(), table["extent"].to_numpy())
        table_of = PerfectHash.of(hashes)
        entry = np.zeros(len(hashes), ENTRY)
        slots = table_of.slots(hashes)
        entry["print"][slots] = hashes >> np.uint64(32)
        for name in ("shard", "nth", "chunk", "offset", "count", "more"):
            entry[name][slots] = table[name].to_numpy()
        sizes, bits = table_of.packed()
        return pd.DataFrame([{"bucket": table["bucket"].iloc[0], "buckets": buckets, "keys": len(hashes),
                              "sizes": sizes, "bits": bits, "entries": entry.tobytes()}])

    built = extents.groupBy("bucket").applyInPandas(build, INDEX)
    built.write.option("compression", "zstd").parquet(f"{path}/index")


INDEX = "bucket int, buckets int, keys bigint, sizes array<bigint>, bits binary, entries binary"


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket")


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The extents of the given keys: ``key, shard, nth, chunk, offset, count``. Keys that the store
    does not have give no row. Only keys are moved, to the index bucket they hash to."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    found = index.select("buckets").first()
    if found is None:
        return spark.createDataFrame([], LOOKED_UP)
    asked = keys.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_KEY)).alias("key")).distinct()
    asked = asked.withColumn("bucket", _bucket(found.buckets))

    def find(wanted: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        rows = []
        left = wanted["key"].to_numpy()
        if len(row) and len(left):
            bits = row["bits"].iloc[0]
            table = PerfectHash.unpacked(list(row["sizes"].iloc[0]), bits)
            entries = np.frombuffer(row["entries"].iloc[0], ENTRY)
            extent = 0
            while len(left):
                hashes = hashed_key(left, np.full(len(left), extent))
                slots = table.slots(hashes)
                there = (slots >= 0) & (entries["print"][slots] == hashes >> np.uint64(32))
                left, got = left[there], entries[slots[there]]
                rows.append(pd.DataFrame({"key": left} | {
                    n: got[n].astype(np.int64) for n in ("shard", "nth", "chunk", "offset", "count")}))
                left, extent = left[got["more"] == 1], extent + 1
        return pd.concat(rows) if rows else pd.DataFrame(columns=LOOKED_UP_NAMES)

    asked = asked.groupBy("bucket").cogroup(index.groupBy("bucket"))
    return asked.applyInPandas(find, LOOKED_UP)


LOOKED_UP_NAMES = ["key", "shard", "nth", "chunk", "offset", "count"]
LOOKED_UP = ", ".join(f"{n} bigint" for n in LOOKED_UP_NAMES)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Every document as it stands in the files: ``shard, nth, chunk, offset, start_in_shard, n_tokens,
    ids_crc32``."""
    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(lengths)
                yield pa.RecordBatch.from_pydict({
                    "shard": np.full(n, r["shard"], np.int64), "nth": r["first_nth"] + np.arange(n),
                    "chunk": np.full(n, r["chunk"], np.int64), "offset": starts * r["width"],
                    "start_in_shard": r["ids_before"] + starts, "n_tokens": lengths,
                    "ids_crc32": np.array(crcs, np.int64)})

    return payload(spark, path).mapInArrow(
        read, "shard bigint, nth bigint, chunk bigint, offset bigint, start_in_shard bigint, "
              "n_tokens bigint, ids_crc32 bigint")


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                shards: int | None = None) -> None:
    """Writes payload and index. ``shards`` is the session's number of shuffle partitions if not
    given: a shard is made by one task. An empty table gives a store without documents."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_payload(docs, path, tokenizer, end_id, shards)
    write_index(spark, path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a store by keyed access: their keys are looked up in the index, the addresses
    lead to the payload. ``doc_id, start, n_tokens, ids_crc32, shard, chunk, byte_offset``."""
    keys = payload(spark, path).select(F.explode("keys").alias("doc_id"))
    at = lookup(spark, path, keys).select(
        "key", "shard", F.explode(F.expr("sequence(nth, nth + count - 1)")).alias("nth"))
    totals = payload(spark, path).groupBy("shard").agg(
        F.max(F.col("ids_before") + F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")).alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    starts = totals.select(F.col("shard").cast("bigint").alias("shard"),
                           F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("shard_start"))
    found = at.join(digests(spark, path), ["shard", "nth"]).join(starts, "shard")
    return found.select(
        F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"),
        (F.col("shard_start") + F.col("start_in_shard")).alias("start"),
        "n_tokens", "ids_crc32", "shard", "chunk", F.col("offset").alias("byte_offset"),
    )
