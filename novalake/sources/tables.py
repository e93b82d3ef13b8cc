"""Partitioned, clustered lake tables and the incremental upsert into them.

Tables are Parquet folders ``<root>/<layer>/<table>``. Where the catalog has
row-level operations, :func:`merge_into` does the upsert there instead.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, StructType

from novalake.operators.combine import match_keys, merge_upsert
from novalake.operators.dedupe import dedupe_by_key
from novalake.operators.reshape import AUDIT, with_audit
from novalake.session import drop_path, new_stage_path
from novalake.sources.compaction import finish_compactions
from novalake.sources.files import fs_path
from novalake.sources.widening import read_widened

# Wanted size of a table file; folder name of a NULL partition.
TARGET_FILE_BYTES = 536870912
# A write below the target size is still shared by up to so many tasks, if each gets as many bytes.
LEAST_TASKS, LEAST_TASK_BYTES = 8, 16777216
# A large batch of a run with a ledger is written in rounds, each of about so many stored bytes to a task.
ROUND_TASK_BYTES = 67108864
# Up to so many ranges a row is compared with their bounds; beyond, Spark's own range exchange is used.
OWN_RANGES = 512
SAMPLED_PER_RANGE = 100
PENDING = "_pending_moves"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives, its key, and how its files are laid out.

    ``day_of`` names the timestamp whose day is a partition (``ts_day``).
    ``key_fixes_partition`` states that equal keys imply equal partitions; only
    then may an upsert skip looking for old rows in other partitions.
    ``unstored`` columns order a batch but are not part of the table.
    ``repeats`` states that batches often hold a key twice, so that they are deduplicated
    before they are staged rather than checked after.
    """

    layer: str
    name: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    day_of: str | None = None
    key_fixes_partition: bool = False
    unstored: tuple[str, ...] = ()
    repeats: bool = False

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.layer}/{self.name}"


def layer_schema(custom: str | None, default: str) -> str:
    """Schema a table goes to: the custom name as given, else the default."""
    return default if custom is None else custom.strip()


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{where}")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder was ever committed; leftovers of a failed
    first write do not count."""
    fs, folder = fs_path(spark, path)
    if not fs.exists(folder):
        return False
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return any(not n.startswith(".") and n != "_temporary" for n in names)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Reads a table; ``schema`` stands in while it has no files to take it from."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(schema).parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """All columns any append ever had, in the widest type one of them had; NULL where a file lacks one."""
    return read_widened(spark, path)


def with_day(df: DataFrame, ts: str | None, day: str = "ts_day") -> DataFrame:
    """Adds the ``days(ts)`` partition column."""
    return df.withColumn(day, F.to_date(ts)) if ts else df


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of a plan's result."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stored_bytes(scan: DataFrame) -> int:
    """Size of the files a scan of a table reads rows from; no column is read for it. For a plan that is more
    than a filtered scan, Spark's estimate."""
    try:
        files = scan.select("_metadata.file_path", "_metadata.file_size").distinct()
    except AnalysisException:
        return estimated_bytes(scan)
    return files.agg(F.sum("file_size")).first()[0] or 0


def scans_parquet(df: DataFrame) -> bool:
    """Whether the rows are those of Parquet files, filtered at most: then a copy of them saves nothing."""
    try:
        df.select("_metadata.row_index")  # only Parquet files have it
    except AnalysisException:
        return False
    return True


def full_waves(tasks: int, cores: int) -> int:
    """More tasks than cores come in waves; so many leave no core idle in the last one."""
    return tasks if tasks <= cores else -(-tasks // cores) * cores


def range_count(size: int, target_file_bytes: int, cores: int = 1, least: int = LEAST_TASKS) -> int:
    """Into how many files of the target size so many bytes go, or ``least`` tasks if they fill no file. Tasks beyond ``cores`` are
    rounded up to full waves, if each still gets enough bytes."""
    files, most = max(1, -(-size // target_file_bytes)), -(-size // LEAST_TASK_BYTES)
    return max(files, min(full_waves(max(files, least), cores), most))


def _bounds(keys: DataFrame, ranges: int) -> list[tuple]:
    """Lower bounds of all ranges but the first, from a sample of the key columns."""
    rows = keys.count()
    share = min(1.0, SAMPLED_PER_RANGE * ranges / max(1, rows))
    sample = keys.sample(share, seed=17) if share < 1 else keys
    got = sorted((tuple(r) for r in sample.collect()), key=lambda r: [(v is not None, v) for v in r])
    cuts = [got[len(got) * n // ranges] for n in range(1, ranges)] if len(got) >= ranges else got
    return list(dict.fromkeys(cuts))


def _range_number(columns: Sequence[str], keys: DataFrame, bounds: list[tuple]) -> Column:
    """How many bounds are at or below a row; NULL sorts first, as in the files."""
    types = [keys.schema[c].dataType for c in columns]
    here = F.struct(*(F.col(c).alias(f"k{n}") for n, c in enumerate(columns)))
    passed = F.lit(0)
    for bound in bounds:
        at = F.struct(*(F.lit(v).cast(t).alias(f"k{n}") for n, (v, t) in enumerate(zip(bound, types))))
        passed = passed + (here >= at).cast("int")
    return passed


def clustered(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    ranges: int,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Range-distributed by partition and sort columns, sorted within files.

    The sort columns take part in the ranges, so a hot partition value, or a hot object, is spread
    over several tasks. Without sort columns adaptive execution splits hot partition values instead.
    ``keys`` has the same keys, more or less, and is cheap to scan: the bounds of the ranges are
    drawn from it, so that ``df`` itself is evaluated once only.
    """
    columns = [*partition_by, *order_by]
    if not order_by:
        return df.hint("rebalance", *columns)
    if ranges > OWN_RANGES:
        return df.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)
    keys = (df if keys is None else keys).select(*columns)
    bounds = _bounds(keys, ranges) if ranges > 1 else []
    spread = df.withColumn("_range", _range_number(columns, keys, bounds))
    spread = spread.repartitionById(len(bounds) + 1, F.col("_range")).drop("_range")
    return spread.sortWithinPartitions(*columns)


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    order_by: Sequence[str] = (),
    target_file_bytes: int = TARGET_FILE_BYTES,
    dynamic: bool = False,
    size: int | None = None,
    keys: DataFrame | None = None,
    least: int = LEAST_TASKS,
) -> None:
    """Writes files of about the target size. ``size`` is the number of bytes to be written, as stored;
    without it Spark's estimate for the plan is taken. ``least`` tasks share what fills fewer files."""
    if size is None:
        size = estimated_bytes(df)
    ranges = range_count(size, target_file_bytes, df.sparkSession.sparkContext.defaultParallelism, least)
    (
        clustered(df, partition_by, order_by, ranges, keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def create_like(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Creates an empty table with the columns of ``df``, unless it exists."""
    if not table_exists(df.sparkSession, path):
        df.limit(0).write.mode("ignore").partitionBy(*partition_by).parquet(path)


def append_evolving(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Appends rows that may bring new columns; read with :func:`read_evolved`. Rows of a partition
    are brought together first, else each task would add a file to each partition."""
    finish_compactions(df.sparkSession, path)
    together = df.hint("rebalance", *partition_by) if partition_by else df
    together.write.mode("append").partitionBy(*partition_by).parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends here,
    so a lost executor never makes the plan behind it run again."""
    path = new_stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, label: str):
    """Like :func:`stage`, for the time of a block: the folder is deleted at its end."""
    path = new_stage_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        drop_path(df.sparkSession, path)


def _partition_folder(columns: Sequence[str]) -> Column:
    """Folder of a row's partition. Made of partition columns only, so a filter
    on it prunes the file listing."""
    return F.concat_ws(
        "/",
        *(
            F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION)))
            for c in columns
        ),
    )


def _partition_folders(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """One string per table partition: bounded by the listing the driver holds anyway."""
    found = df.select(_partition_folder(columns).alias("folder")).distinct()
    return {row.folder for row in found.collect()}


def _rounds(scans: Sequence[DataFrame], parts: Sequence[str], most: int) -> list[tuple[int, list[str]]]:
    """Table partitions in groups of about ``most`` stored bytes, a larger one alone, and the bytes of each. No groups if files hold
    rows of several partitions, since every round would read them again, or if the rows are not those of files."""
    try:
        files = reduce(DataFrame.unionAll, (
            scan.select(_partition_folder(parts).alias("folder"), "_metadata.file_path", "_metadata.file_size")
            for scan in scans)).distinct()
    except AnalysisException:
        return []
    if has_duplicates(files, ["file_path"]):
        return []
    groups: list[tuple[int, list[str]]] = []
    for folder, size in sorted(map(tuple, files.groupBy("folder").agg(F.sum("file_size")).collect())):
        filled, folders = groups.pop() if groups and groups[-1][0] + size <= most else (0, [])
        groups.append((filled + size, [*folders, folder]))
    return groups


def _file_folders(table: DataFrame) -> list[str]:
    """URIs of the folders the files of ``table`` lie in."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    return [row.folder for row in table.select(folder.alias("folder")).distinct().collect()]


def within_key_range(batch: DataFrame, keys: Sequence[str], null_safe: bool = False) -> Column:
    """What every row that shares a key with ``batch`` meets: its keys lie between the least and the greatest of the batch.

    Alert ids grow with time, so a scan with this condition skips, by the statistics of files and row groups, the years
    before the batch. One pass over the batch's keys; whole numbers, texts and dates count, other types are not looked at.
    """
    ranged = [k for k in keys if isinstance(batch.schema[k].dataType, (IntegralType, StringType, DateType))]
    if not ranged:
        return F.lit(True)
    ends = [(F.min(k).alias(f"least{n}"), F.max(k).alias(f"most{n}")) for n, k in enumerate(ranged)]
    found = batch.agg(*(end for pair in ends for end in pair)).first()
    conditions = []
    for n, k in enumerate(ranged):
        least, most = found[f"least{n}"], found[f"most{n}"]
        kind = batch.schema[k].dataType
        inside = F.lit(False) if least is None else F.col(k).between(F.lit(least).cast(kind), F.lit(most).cast(kind))
        conditions.append(inside | F.col(k).isNull() if null_safe else inside)
    return reduce(and_, conditions)


def _rows_to_replace(table: DataFrame, batch: DataFrame, spec: TableSpec, null_safe: bool) -> DataFrame:
    """Keys and partitions of the stored rows whose key is in the batch."""
    held_keys = table.select(*dict.fromkeys([*spec.keys, *spec.partition_by]))
    near = held_keys.where(within_key_range(batch, spec.keys, null_safe))
    return match_keys(near, batch, spec.keys, "left_semi", null_safe)


def has_duplicates(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether any key occurs twice: a shuffle of partly counted keys only."""
    return not df.groupBy(*keys).count().where("count > 1").isEmpty()


def _note_moves(spark: SparkSession, path: str, folders: list[str]) -> str:
    """Notes, before a write, the folders that will be stale after it."""
    note = f"{path}/{PENDING}/{uuid.uuid4().hex}"
    fs, file = fs_path(spark, note)
    out = fs.create(file)
    out.write(bytearray("\n".join(folders).encode()))
    out.close()
    return note


def _delete_folders(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def finish_moves(spark: SparkSession, root: str, spec: TableSpec, null_safe: bool = False) -> None:
    """Finishes the deletions of an upsert that stopped after its write.

    A noted folder goes if every key in it is found in another folder as well. If the write did not
    come to its end, the rows are nowhere else and the folder stays.
    """
    path = spec.path(root)
    fs, folder = fs_path(spark, f"{path}/{PENDING}")
    if not fs.exists(folder):
        return
    for status in fs.listStatus(folder):
        note = status.getPath()
        noted = [row.value for row in spark.read.text(note.toString()).collect()]
        table = read_table(spark, path)
        at = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
        rows = table.withColumn("_folder", at).select(*spec.keys, "_folder")
        inside = F.col("_folder").isin(noted)
        alone = match_keys(rows.where(inside), rows.where(~inside), spec.keys, "left_anti", null_safe)
        only_here = {row[0] for row in alone.select("_folder").distinct().collect()}
        _delete_folders(spark, [f for f in noted if f not in only_here])
        fs.delete(note, False)


def _unique_batch(
    kept: ExitStack,
    source: DataFrame,
    spec: TableSpec,
    latest: Sequence[str],
    null_safe: bool,
    staged: bool,
) -> DataFrame:
    """The batch with one row per key, as a stored table. One copy is made, none if ``staged``; a second
    takes the first one's place where keys turn out to repeat."""
    keys, label = list(spec.keys), f"batch-{spec.name}"
    rows = with_day(source, spec.day_of)
    if spec.repeats:
        return kept.enter_context(held(dedupe_by_key(rows, keys, latest, null_safe), label))
    with ExitStack() as first:
        if not staged:
            rows = first.enter_context(held(rows, label))
        if has_duplicates(rows, keys):
            return kept.enter_context(held(dedupe_by_key(rows, keys, latest, null_safe), label))
        kept.push(first.pop_all())
    return rows


def upsert_table(
    source: DataFrame,
    root: str,
    spec: TableSpec,
    latest: Sequence[str] = (),
    null_safe: bool = False,
    audit: bool = True,
    evolve: bool = False,
    staged: bool = False,
    stamp: dt.datetime | None = None,
) -> None:
    """Upserts a batch into a table, rewriting only the partitions it touches.

    Of several source rows with one key the one with the greatest ``latest`` wins; the spec's
    ``unstored`` columns are dropped after that. The first run creates the table.

    The batch is staged in the shared folder, since several passes read it, unless ``staged`` says that
    it is a stored table already; the copy is deleted at the end. Touched partitions are those of the
    batch plus, unless the key fixes the partition, those now holding rows that the batch replaces (a
    scan of the key columns only, of row groups within the batch's range of keys). Spark writes the new partitions aside and swaps them in when
    all tasks are done, so reading and replacing the same partitions in one job is safe. Folders that
    lose all their rows are noted before the write; :func:`finish_moves`, at the start of each upsert,
    deletes them if a run stopped in between.

    A batch whose columns differ from the table's is refused, since rewriting a partition could lose
    columns; ``evolve`` reads every file's schema and keeps the columns of both.

    ``stamp`` is the audit time of the batch. Stored rows that bear it come from an earlier, broken attempt at the
    same batch and are replaced, whatever their keys. A large batch with a stamp that lies in folders of the table's partitions
    is written some partitions at a time, so that shuffle and spill files of only these are on the disks; after a stop in
    between, the next attempt with that stamp puts the table right.
    """
    path = spec.path(root)
    if table_exists(source.sparkSession, path):
        finish_compactions(source.sparkSession, path)
        finish_moves(source.sparkSession, root, spec, null_safe)
    with ExitStack() as kept:
        batch = _unique_batch(kept, source, spec, latest, null_safe, staged)
        _upsert(batch, path, spec, null_safe, audit, evolve, stamp)


def _upsert(
    stored: DataFrame, path: str, spec: TableSpec, null_safe: bool, audit: bool, evolve: bool,
    stamp: dt.datetime | None = None,
) -> None:
    spark, keys, parts = stored.sparkSession, list(spec.keys), list(spec.partition_by)
    columns = [*parts, *spec.order_by]
    batch = stored.drop(*spec.unstored)
    if audit:
        batch = with_audit(batch, at=stamp)
    size = stored_bytes(stored)
    cores = spark.sparkContext.defaultParallelism
    tasks = full_waves(max(LEAST_TASKS, cores), cores)

    def rounds(size: int, *scans: DataFrame) -> list[tuple[dict, Callable[[DataFrame], DataFrame]]]:
        """How each round is written, and what takes its rows: all rows in one, unless they are many and a stopped run would be taken up."""
        groups = []
        if stamp and audit and size > ROUND_TASK_BYTES * tasks:
            groups = _rounds(scans, parts, ROUND_TASK_BYTES * tasks)
        return [({"size": share, "least": tasks}, lambda rows, group=group: rows.where(_partition_folder(parts).isin(group)))
                for share, group in groups] or [({"size": size}, lambda rows: rows)]

    if not table_exists(spark, path):
        for n, (how, some) in enumerate(rounds(size, stored)):
            write_clustered(some(batch), path, parts, spec.order_by, dynamic=n > 0, keys=some(stored), **how)
        return

    table = read_evolved(spark, path) if evolve else read_table(spark, path, batch.schema)
    if not evolve and set(table.columns) != set(batch.columns):
        raise ValueError(f"columns of {path} and of the batch differ: "
                         f"{sorted(set(table.columns) ^ set(batch.columns))}")

    def in_folders(folders: set[str]) -> DataFrame:
        return table.where(_partition_folder(parts).isin(sorted(folders)))

    new = _partition_folders(stored, parts)
    if not new:
        return
    old: set[str] = set()
    if not spec.key_fixes_partition:
        old = _partition_folders(_rows_to_replace(table, stored, spec, null_safe), parts)
    emptied = old - new
    if emptied:
        staying = match_keys(in_folders(emptied), stored, keys, "left_anti", null_safe)
        emptied -= _partition_folders(staying, parts)
    stale = _file_folders(in_folders(emptied)) if emptied else []
    touched = in_folders(new | old)
    note = _note_moves(spark, path, stale) if stale else None
    earlier = touched.where(~F.col(AUDIT).eqNullSafe(F.lit(stamp))) if stamp and audit else touched
    # a row and the one it replaces may lie in partitions of two rounds, so each round meets the keys of the whole batch
    merged = merge_upsert(earlier, batch, keys, null_safe)
    places = touched.select(*columns).unionByName(stored.select(*columns))
    for how, some in rounds(size + stored_bytes(touched), stored, touched):
        write_clustered(some(merged), path, parts, spec.order_by, dynamic=True, keys=some(places), **how)
    _delete_folders(spark, stale)
    if note:
        fs, file = fs_path(spark, note)
        fs.delete(file, False)


def merge_into(source: DataFrame, table: str, keys: Sequence[str], null_safe: bool = False) -> None:
    """The same upsert as a MERGE, for catalogs with row-level operations."""
    pairs = [(F.col(f"{table}.{k}"), F.col(f"source.{k}")) for k in keys]
    match = reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))
    (
        source.alias("source")
        .mergeInto(table, match)
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )
