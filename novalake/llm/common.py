"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from novalake.session import new_stage_path

BATCH_BYTES = 4 << 20
# At most so many bytes of flags, one bit for a row, go out at once.
FLAG_BYTES = 32 << 20
# Workers live from stage to stage. With these they give large pieces of memory back when they are freed.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
}


def shared_code(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it, besides their own paths, and keep no more
    memory than they use."""
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shared_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later steps neither
    compute it again nor depend on an executor that may be lost. The folder goes
    when the driver ends."""
    spark = df.sparkSession
    path = new_stage_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back_memory() -> None:
    """Returns freed memory of this process to the machine, after a step that needed much more than those that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that ``column`` has about ``limit`` bytes in each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def pack_longs(array: pa.Array) -> tuple[bytes, bytes]:
    """A long column as bytes, and which of its values are null. Inside lists pandas would turn longs
    beside nulls into doubles."""
    missing = array.is_null().to_numpy(zero_copy_only=False)
    return pa.compute.fill_null(array.cast(pa.int64()), 0).to_numpy().tobytes(), missing.tobytes()


def unpack_longs(values: bytes, missing: bytes) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(np.frombuffer(values, np.int64).copy(), np.frombuffer(missing, bool).copy())


def _is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is stored files, with columns chosen at most: then a row of a file is a row of ``df``."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


class Places:
    """Numbers that stand for the rows of a table, the same in every scan however files are cut: the number of a
    Parquet file in the upper bits, the row in it in the lower 33. A plan that is no scan is stored first."""

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        if not _is_scan(docs):
            docs = staged(docs, "placed")
        path, number, row = ("_path", "_file", "_row")
        while {path, number, row} & set(docs.columns):
            path, number, row = path + "_", number + "_", row + "_"
        self.path, self.number, self.row = path, number, row
        self.docs = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row))
        files = docs.select(F.col("_metadata.file_path").alias(path)).distinct()
        # a row for each file, as in the listing that the driver holds anyway
        self.names = sorted(r[0] for r in files.collect())
        self.files = docs.sparkSession.createDataFrame(
            [(n, name) for n, name in enumerate(self.names)], f"{number} bigint, {path} string")

    def rows(self, place: str, first: int = 0, last: int | None = None) -> DataFrame:
        """All rows, or those of some neighbouring files, with their place."""
        docs = self.docs
        if last is not None:
            docs = docs.filter(F.col(self.path).between(self.names[first], self.names[last]))
        placed = docs.join(F.broadcast(self.files), self.path)
        at = F.shiftleft(F.col(self.number), 33) + F.col(self.row)
        return placed.select(*(F.col(f"`{c}`") for c in self.columns), at.alias(place))

    def rows_at(self, places: DataFrame, place: str) -> DataFrame:
        """The rows whose place is among ``places`` (one column).

        What crosses a shuffle is places; the rows themselves are filtered as they are scanned, by one bit for each row of
        their file. The bits go out in blocks of FLAG_BYTES at most (or one file's), each for the scan of its files.
        """
        part, bits = "_part", "_bits"
        while {part, bits} & {*self.columns, place}:
            part, bits = part + "_", bits + "_"

        def flagged(table: pa.Table) -> pa.Table:
            nth = table["nth"].to_numpy()
            found = np.zeros(int(nth.max()) + 1, np.uint8)
            found[nth] = 1
            return pa.table({part: table[part][:1], bits: [np.packbits(found, bitorder="little").tobytes()]})

        at = F.col(places.columns[0])
        split = places.select(F.shiftright(at, 33).alias(part), at.bitwiseAND((1 << 33) - 1).alias("nth"))
        flags = staged(split.groupBy(part).applyInArrow(lambda t: flagged(t), f"{part} bigint, {bits} binary"), "flags")
        blocks, held = [], 0
        for number, size in flags.select(part, F.octet_length(bits)).orderBy(part).collect():
            if not blocks or held + size > FLAG_BYTES:
                blocks.append([number, number])
                held = 0
            blocks[-1][1] = number
            held += size
        if not blocks:
            return self.rows(place).limit(0)
        nth = F.col(place).bitwiseAND((1 << 33) - 1)
        byte = F.conv(F.hex(F.substr(F.col(bits), (F.floor(nth / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        asked = byte.bitwiseAND(F.expr(f"shiftleft(1, cast(`{place}` & 7 as int))")) != 0

        def block(first: int, last: int) -> DataFrame:
            theirs = F.broadcast(flags.filter(F.col(part).between(first, last)))
            mine = self.rows(place, first, last)
            return mine.join(theirs, F.shiftright(F.col(place), 33) == F.col(part)).filter(asked).select(
                *(F.col(f"`{c}`") for c in mine.columns))

        return reduce(DataFrame.union, [block(*b) for b in blocks])
