"""Small files of a table, as many appends leave them, put together into files of the target size.

Files under half of the target size are packed, folder by folder, into bins of it; larger files, and files alone in their bin,
stay as they are. Each bin is one task and becomes one file, sorted like the table's other files, in a folder of its own
below ``_compacting``. Only when all are written a plan of the moves is noted; then each new file takes the place of its old
ones. A run that stopped before the note has changed nothing; after it, the next call of
:func:`finish_compactions` (every upsert, append and compaction begins with it) makes the moves that are left.

The list of files passes through the driver, as it does in every scan; rows do not. Like all writes of a lake, one at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from novalake.sources.files import fs_path, fs_uri, read_note, write_note
from novalake.sources.widening import merged_schema

COMPACTING = "_compacting"
PLAN = "plan.json"
BIN = "compaction_bin"


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """``file_path, file_size`` of the table's files that hold rows. No column is read for it."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return rows.select("_metadata.file_path", "_metadata.file_size").distinct()


def packed_bins(files: Sequence[tuple[str, int]], target: int) -> list[list[str]]:
    """First fit, largest first: groups of two files or more of one folder, of ``target`` bytes together at most."""
    bins: list[list] = []  # folder, bytes, names
    open_bins: dict[str, list[list]] = {}
    for name, size in sorted(files, key=lambda f: (-f[1], f[0])):
        if 2 * size >= target:
            continue
        mine = open_bins.setdefault(name.rsplit("/", 1)[0], [])
        fitting = next((b for b in mine if b[0] + size <= target), None)
        if fitting is None:
            fitting = [0, []]
            mine.append(fitting)
            bins.append(fitting)
        fitting[0] += size
        fitting[1].append(name)
        if 8 * (target - fitting[0]) < target:  # nearly full: files that still fit hardly matter, the search does
            mine.remove(fitting)
    return [names for _, names in bins if len(names) > 1]


def compact_table(
    spark: SparkSession, path: str, target_file_bytes: int, order_by: Sequence[str] = (),
) -> int:
    """Puts small files together; returns how many files went. Rows, columns that some files lack, and folders stay as they are."""
    finish_compactions(spark, path)
    bins = packed_bins([tuple(r) for r in table_files(spark, path).collect()], target_file_bytes)
    if not bins:
        return 0
    names = [fs_uri(spark, name)[1].toString() for group in bins for name in group]
    reader = spark.read.option("recursiveFileLookup", "true")
    schema = merged_schema(spark, names)
    rows = reader.schema(schema).parquet(*names)
    where = spark.createDataFrame(
        [(name, n) for n, group in enumerate(bins) for name in group], f"_of string, {BIN} int")
    binned = rows.withColumn("_of", F.col("_metadata.file_path")).join(F.broadcast(where), "_of").drop("_of")
    together = binned.repartitionById(len(bins), F.col(BIN))
    # partition columns are the same throughout a folder, and not in its files
    ordered = together.sortWithinPartitions(BIN, *(c for c in order_by if c in schema.names))
    folder = f"{path}/{COMPACTING}/{uuid.uuid4().hex}"
    ordered.write.partitionBy(BIN).parquet(folder)
    write_note(spark, f"{folder}/{PLAN}", json.dumps(bins))
    finish_compactions(spark, path)
    return sum(map(len, bins)) - len(bins)


def _move_bin(spark: SparkSession, folder: str, number: int, old: list[str]) -> None:
    fs, made = fs_path(spark, f"{folder}/{BIN}={number}")
    _, home = fs_uri(spark, old[0].rsplit("/", 1)[0])
    for status in fs.listStatus(made) if fs.exists(made) else []:
        file = status.getPath()
        to = spark._jvm.org.apache.hadoop.fs.Path(home, file.getName())
        if not fs.rename(file, to):
            raise OSError(f"{file} could not be moved to {to}")
    for name in old:
        fs.delete(fs_uri(spark, name)[1], False)


def finish_compactions(spark: SparkSession, path: str) -> None:
    """Makes the moves a stopped compaction noted, and drops what one wrote without a note."""
    fs, folder = fs_path(spark, f"{path}/{COMPACTING}")
    if not fs.exists(folder):
        return
    for status in fs.listStatus(folder):
        run = status.getPath().toString()
        if fs.exists(fs_path(spark, f"{run}/{PLAN}")[1]):
            for number, old in enumerate(json.loads(read_note(spark, f"{run}/{PLAN}"))):
                _move_bin(spark, run, number, old)
        fs.delete(status.getPath(), True)
    fs.delete(folder, True)
