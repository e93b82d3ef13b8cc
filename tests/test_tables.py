from __future__ import annotations

import datetime as dt
import time
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from novalake import session
from novalake.session import new_stage_path, shared_dir
from novalake.sources import tables
from novalake.sources.tables import (
    TableSpec,
    append_evolving,
    create_like,
    layer_schema,
    read_evolved,
    read_table,
    table_exists,
    upsert_table,
    within_key_range,
    with_day,
    write_clustered,
)

SPEC = TableSpec("silver", "t", ("id",), ("ts_day",), ("id", "ts"), "ts")


def batch(spark, *rows):
    values = ", ".join(f"({i}, TIMESTAMP '{ts}', '{v}')" for i, ts, v in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} t(id, ts, v)")


def content(spark, root, spec=SPEC):
    df = read_table(spark, spec.path(root)).select("id", "v", "ts_day")
    return sorted((r.id, r.v, str(r.ts_day)) for r in df.collect())


@pytest.fixture
def root(spark):
    return new_stage_path(spark, "lake")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_first_run_creates_then_upserts(spark, root):
    assert not table_exists(spark, SPEC.path(root))
    upsert_table(batch(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b")), root, SPEC)
    upsert_table(batch(spark, (2, "2024-01-02", "B"), (3, "2024-01-03", "c")), root, SPEC)
    want = [(1, "a", "2024-01-01"), (2, "B", "2024-01-02"), (3, "c", "2024-01-03")]
    assert content(spark, root) == want
    upsert_table(batch(spark, (2, "2024-01-02", "B"), (3, "2024-01-03", "c")), root, SPEC)
    assert content(spark, root) == want


def test_rerun_updates_the_audit_column(spark, root):
    rows = batch(spark, (1, "2024-01-01", "a"))
    upsert_table(rows, root, SPEC)
    first = read_table(spark, SPEC.path(root)).first()._created_ts
    upsert_table(rows, root, SPEC)
    table = read_table(spark, SPEC.path(root))
    assert table.count() == 1 and table.first()._created_ts > first


def test_untouched_partitions_keep_their_files(spark, root):
    upsert_table(batch(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b")), root, SPEC)
    files = lambda: {r[0] for r in read_table(spark, SPEC.path(root)).where("ts_day = '2024-01-01'")
                     .select("_metadata.file_path").collect()}
    before = files()
    upsert_table(batch(spark, (2, "2024-01-02", "B")), root, SPEC)
    assert files() == before


def test_row_that_changes_partition_is_moved(spark, root):
    upsert_table(batch(spark, (1, "2024-01-01", "a"), (2, "2024-01-01", "b"), (3, "2024-01-05", "c")), root, SPEC)
    upsert_table(batch(spark, (1, "2024-01-02", "A"), (3, "2024-01-06", "C")), root, SPEC)
    assert content(spark, root) == [(1, "A", "2024-01-02"), (2, "b", "2024-01-01"), (3, "C", "2024-01-06")]


def test_duplicate_source_keys(spark, root):
    rows = batch(spark, (1, "2024-01-01", "a"), (1, "2024-01-01", "z"), (1, "2024-01-01", "m"))
    upsert_table(rows, root, SPEC)
    assert content(spark, root) == [(1, "z", "2024-01-01")]


@pytest.mark.parametrize("null_safe, count", [(False, 2), (True, 1)])
def test_null_keys(spark, root, null_safe, count):
    rows = batch(spark, ("CAST(NULL AS INT)", "2024-01-01", "a"))
    for _ in range(2):
        upsert_table(rows, root, SPEC, null_safe=null_safe)
    assert read_table(spark, SPEC.path(root)).count() == count


def test_null_partition(spark, root):
    spec = TableSpec("silver", "n", ("id",), ("kind",), ("id",))
    df = spark.sql("SELECT * FROM VALUES (1, NULL, 'a'), (2, 'x', 'b') t(id, kind, v)")
    upsert_table(df, root, spec)
    upsert_table(spark.sql("SELECT 1 AS id, 'x' AS kind, 'A' AS v"), root, spec)
    got = sorted((r.id, r.kind, r.v) for r in read_table(spark, spec.path(root)).collect())
    assert got == [(1, "x", "A"), (2, "x", "b")]


def test_partition_names_that_need_escaping(spark, root):
    spec = TableSpec("silver", "n", ("id",), ("kind",), ("id",))
    df = spark.sql("SELECT * FROM VALUES (1, 'a:b c/d%', 'a'), (2, 'x', 'b') t(id, kind, v)")
    upsert_table(df, root, spec)
    upsert_table(spark.sql("SELECT 1 AS id, 'x' AS kind, 'A' AS v"), root, spec)
    got = sorted((r.id, r.kind, r.v) for r in read_table(spark, spec.path(root)).collect())
    assert got == [(1, "x", "A"), (2, "x", "b")]


def test_failed_first_write_is_no_table(spark, tmp_path):
    (tmp_path / "t" / "_temporary").mkdir(parents=True)
    assert not table_exists(spark, f"file://{tmp_path}/t")
    (tmp_path / "t" / "ts_day=2024-01-01").mkdir()
    assert table_exists(spark, f"file://{tmp_path}/t")


def test_new_columns_only_on_request(spark, root):
    upsert_table(batch(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b")), root, SPEC)
    wider = batch(spark, (2, "2024-01-02", "B")).withColumn("extra", F.lit(9))
    with pytest.raises(ValueError, match="extra"):
        upsert_table(wider, root, SPEC)
    upsert_table(wider, root, SPEC, evolve=True)
    upsert_table(batch(spark, (3, "2024-01-02", "c")), root, SPEC, evolve=True)
    got = sorted((r.id, r.v, r.extra) for r in read_evolved(spark, SPEC.path(root)).collect())
    assert got == [(1, "a", None), (2, "B", 9), (3, "c", None)]


def test_empty_batch(spark, root):
    upsert_table(batch(spark, (1, "2024-01-01", "a")), root, SPEC)
    upsert_table(batch(spark, (1, "2024-01-01", "a")).limit(0), root, SPEC)
    assert content(spark, root) == [(1, "a", "2024-01-01")]


def test_files_are_sorted_and_ranges_do_not_mix(spark, root):
    df = spark.range(5000).select(
        (F.col("id") * 7919 % 5000).alias("id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"),
    )
    write_clustered(with_day(df, "ts"), root, ["ts_day"], ["id", "ts"])
    table = read_table(spark, root).select(
        "*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")
    )
    step = table.withColumn("p", F.lag("id").over(Window.partitionBy("f").orderBy("i")))
    assert step.where("p > id").count() == 0 and table.count() == 5000
    ranges = table.groupBy("ts_day", "f").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    mixed = ranges.alias("a").join(ranges.alias("b"), "ts_day").where("a.f < b.f AND a.lo <= b.hi AND b.lo <= a.hi")
    assert mixed.count() == 0


def test_create_like_and_evolving_append(spark, root):
    df = spark.sql("SELECT 1 AS id, 'a' AS v")
    create_like(df, root)
    assert read_table(spark, root, df.schema).count() == 0 and table_exists(spark, root)
    append_evolving(df, root)
    create_like(df, root)
    append_evolving(spark.sql("SELECT 2 AS id, 2.5D AS w"), root)
    got = sorted((r.id, r.v, r.w) for r in read_evolved(spark, root).collect())
    assert got == [(1, "a", None), (2, None, 2.5)]


def test_layer_schema():
    assert layer_schema(None, "default") == "default"
    assert layer_schema(" silver ", "default") == "silver"


def counted(spark, df):
    """Rows that pass through a counter, and the counter."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def count(x):
        seen.add(1)
        return x

    return df.withColumn("id", count.asNondeterministic()("id")), seen


def many(spark, n):
    return spark.range(0, n, 1, 8).select(
        (F.col("id") * 7919 % n).alias("id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3 * 86400).alias("ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )


def test_a_clustered_write_evaluates_its_input_once(spark, root):
    keys = with_day(many(spark, 6000), "ts")
    df, seen = counted(spark, keys)
    write_clustered(df, root, ["ts_day"], ["id", "ts"], target_file_bytes=100_000, size=600_000, keys=keys)
    assert seen.value == 6000 and read_table(spark, root).count() == 6000


@pytest.mark.parametrize("partitions", ["2", "40"])
def test_files_are_near_the_target_size(spark, root, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = many(spark, 60_000).withColumn("kind", F.lit("one"))
        size = 60_000 * 70
        write_clustered(df, root, ["kind"], ["id", "ts"], target_file_bytes=400_000, size=size)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = [r.file_size for r in read_table(spark, root).select("_metadata.file_path", "_metadata.file_size").distinct().collect()]
    assert 200_000 <= min(sizes) and max(sizes) <= 800_000


def test_writes_leave_no_setting_behind(spark, root):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    upsert_table(batch(spark, (1, "2024-01-01", "a")), root, SPEC)
    assert spark.conf.get(key) == before


def test_staged_copies_go_with_the_upsert(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    for spec in (SPEC, replace(SPEC, repeats=True)):
        for _ in range(2):
            rows = batch(spark, (1, "2024-01-01", "a"), (1, "2024-01-01", "b"), (2, "2024-01-02", "c"))
            upsert_table(rows, f"file://{tmp_path}/lake", spec)
        assert list((tmp_path / "shared").iterdir()) == []


def test_stored_batch_is_not_staged_again(spark, root, monkeypatch):
    rows = batch(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b"))
    rows.write.parquet(f"{root}/batch")
    monkeypatch.setattr(tables, "held", None)
    upsert_table(spark.read.parquet(f"{root}/batch"), f"{root}/lake", SPEC, staged=True)
    assert content(spark, f"{root}/lake") == [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")]


def test_a_run_that_stops_before_its_deletions_is_finished_by_the_next(spark, root, monkeypatch):
    upsert_table(batch(spark, (1, "2024-01-01", "a"), (2, "2024-01-05", "b")), root, SPEC)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken:
        broken.setattr(tables, "_delete_folders", stop)
        with pytest.raises(RuntimeError):
            upsert_table(batch(spark, (1, "2024-01-02", "A")), root, SPEC)
    assert content(spark, root) == [(1, "A", "2024-01-02"), (1, "a", "2024-01-01"), (2, "b", "2024-01-05")]
    upsert_table(batch(spark, (3, "2024-01-06", "c")), root, SPEC)
    assert content(spark, root) == [(1, "A", "2024-01-02"), (2, "b", "2024-01-05"), (3, "c", "2024-01-06")]


def test_a_run_that_stops_before_its_write_loses_nothing(spark, root, monkeypatch):
    upsert_table(batch(spark, (1, "2024-01-01", "a"), (2, "2024-01-05", "b")), root, SPEC)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken:
        broken.setattr(tables, "write_clustered", stop)
        with pytest.raises(RuntimeError):
            upsert_table(batch(spark, (1, "2024-01-02", "A")), root, SPEC)
    upsert_table(batch(spark, (3, "2024-01-06", "c")), root, SPEC)
    assert content(spark, root) == [(1, "a", "2024-01-01"), (2, "b", "2024-01-05"), (3, "c", "2024-01-06")]


def test_appends_bring_the_rows_of_a_partition_together(spark, root):
    rows = many(spark, 3000).withColumn("kind", F.col("id") % 10)
    append_evolving(rows, root, ["kind"])
    files = read_table(spark, root).select("_metadata.file_path").distinct().count()
    assert files <= 20


def test_a_local_session_without_shared_folder_gets_its_own(spark):
    class Bare:
        conf, sparkContext = type("C", (), {"get": staticmethod(lambda *_: None)}), spark.sparkContext

    first = shared_dir(Bare)
    assert first.startswith("file:///") and shared_dir(Bare) == first


def cluster(spark, app, names, checkpoints=None, written=None):
    """A session as executors in processes of their own would give it. ``names``: its settings; ``written``: tasks whose
    files reach the driver's folder."""
    context = SimpleNamespace(master="local-cluster[3,2,1024]", applicationId=app, defaultParallelism=4,
                              getCheckpointDir=lambda: checkpoints)
    made = (lambda *_: spark.range(0, written, 1, written)) if written else spark.range
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *rest: names.get(key, *rest)), sparkContext=context,
                           range=made, _jvm=spark._jvm, _jsc=spark._jsc)


def test_executors_in_their_own_processes_get_no_temporary_folder(spark, tmp_path):
    warehouse, named = f"file://{tmp_path}/warehouse", f"{tmp_path}/named"
    names = {"spark.sql.warehouse.dir": warehouse}
    assert shared_dir(cluster(spark, "a", names)) == f"{warehouse}/novalake-staged"
    assert shared_dir(cluster(spark, "b", names, f"file:{tmp_path}/set")) == f"file:{tmp_path}/set"
    assert shared_dir(cluster(spark, "c", names | {"spark.checkpoint.dir": f"{named}/"})) == named
    assert list((tmp_path / "named").iterdir()) == []


def test_a_folder_that_lacks_files_of_executors_is_refused(spark, tmp_path):
    names = {"spark.checkpoint.dir": f"file://{tmp_path}/own"}
    with pytest.raises(RuntimeError, match="finds 1 of 4 files"):
        shared_dir(cluster(spark, "d", names, written=1))


def test_a_named_folder_of_each_machine_is_passed_over(spark, tmp_path):
    session = cluster(spark, "e", {"spark.checkpoint.dir": f"file://{tmp_path}/own", "spark.sql.warehouse.dir": f"file://{tmp_path}/house"})
    session.range = lambda start, end, step, tasks: spark.range(0, 1 if not (tmp_path / "own").exists() else tasks, 1, tasks)
    with pytest.warns(UserWarning, match="/own is a folder of each machine's own"):
        assert shared_dir(session) == f"file://{tmp_path}/house/novalake-staged"
    assert shared_dir(session) == f"file://{tmp_path}/house/novalake-staged"  # tried once


def test_a_folder_that_cannot_be_written_is_passed_over(spark, tmp_path):
    (tmp_path / "file").touch()
    names = {"spark.checkpoint.dir": f"file://{tmp_path}/file/own", "spark.sql.warehouse.dir": f"file://{tmp_path}/house"}
    with pytest.warns(UserWarning, match="tables are staged in"):
        assert shared_dir(cluster(spark, "f", names)) == f"file://{tmp_path}/house/novalake-staged"


def scanned_rows(df):
    """Rows the scans of an executed plan brought in."""
    def scans(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return scans(node.executedPlan())
        if node.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage")):
            return scans(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            return [node.metrics().apply("numOutputRows").value()]
        children = node.children()
        return [n for i in range(children.size()) for n in scans(children.apply(i))]

    df.collect()
    return scans(df._jdf.queryExecution().executedPlan())


def test_old_rows_are_looked_for_in_the_batchs_range_of_keys(spark, root):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / 1000).cast("int"))
    stored = spark.range(20_000).select("id", day.cast("timestamp").alias("ts"), F.lit("a").alias("v"))
    upsert_table(stored, root, SPEC)
    table = read_table(spark, SPEC.path(root))
    moved = spark.range(7_000, 7_010).select("id", F.lit("2024-03-01").cast("timestamp").alias("ts"), F.lit("b").alias("v"))
    held = tables._rows_to_replace(table, with_day(moved, "ts"), SPEC, False)
    rows = scanned_rows(held)
    assert held.count() == 10 and sum(rows) <= 1_010  # one day of twenty, and the batch
    upsert_table(moved, root, SPEC)
    got = read_table(spark, SPEC.path(root))
    assert got.count() == 20_000 and got.where("v = 'b' AND ts_day = '2024-03-01'").count() == 10


@pytest.mark.parametrize("null_safe", [False, True])
def test_key_range_holds_every_match(spark, null_safe):
    rows = spark.sql("SELECT * FROM VALUES (1, 'a', 1.5D), (5, 'b', 2D), (NULL, 'c', 3D), (9, NULL, NULL), (NULL, NULL, NULL) t(i, s, d)")
    for n, batch_rows in enumerate((rows, rows.where("i IS NULL"), rows.where("i = 5"), rows.limit(0))):
        condition = within_key_range(batch_rows, ["i", "s", "d"], null_safe)
        match = lambda df: sorted(map(str, tables.match_keys(df, batch_rows, ["i", "s", "d"], "left_semi", null_safe).collect()))
        assert match(rows.where(condition)) == match(rows), n
    assert rows.where(within_key_range(rows.where("i = 5"), ["i"], null_safe)).count() == (3 if null_safe else 1)
    assert rows.where(within_key_range(rows.where("i = 5"), ["d"], null_safe)).count() == 5


STAMP = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)


def in_folders(spark, path, *rows):
    """A batch that is stored by day, as landing files are."""
    with_day(batch(spark, *rows), "ts").write.partitionBy("ts_day").parquet(path)
    return spark.read.parquet(path)


def noted_writes(monkeypatch, fail_at=None):
    """Counts the writes from now on; one of them may fail."""
    writes, theirs = [], tables.write_clustered

    def write(*args, **how):
        if len(writes) == fail_at:
            raise RuntimeError("stopped")
        writes.append(how)
        theirs(*args, **how)

    monkeypatch.setattr(tables, "write_clustered", write)
    return writes


def test_a_large_batch_is_written_in_rounds(spark, root, monkeypatch):
    monkeypatch.setattr(tables, "ROUND_TASK_BYTES", 1)
    writes = noted_writes(monkeypatch)
    first = in_folders(spark, f"{root}/one", (1, "2024-01-01", "a"), (2, "2024-01-01", "b"), (3, "2024-01-05", "c"))
    upsert_table(first, root, SPEC, staged=True, stamp=STAMP)
    assert len(writes) == 2 and [w["dynamic"] for w in writes] == [False, True]
    later = STAMP + dt.timedelta(days=1)
    second = in_folders(spark, f"{root}/two", (1, "2024-01-02", "A"), (3, "2024-01-01", "C"), (4, "2024-01-09", "d"))
    upsert_table(second, root, SPEC, staged=True, stamp=later)
    assert len(writes) == 2 + 4  # 01-05 has a round too, in which it loses its only row
    want = [(1, "A", "2024-01-02"), (2, "b", "2024-01-01"), (3, "C", "2024-01-01"), (4, "d", "2024-01-09")]
    assert content(spark, root) == want


def test_rounds_need_a_stamp_and_files_of_one_partition_each(spark, root, monkeypatch):
    monkeypatch.setattr(tables, "ROUND_TASK_BYTES", 1)
    writes, rows = noted_writes(monkeypatch), ((1, "2024-01-01", "a"), (2, "2024-01-02", "b"))
    upsert_table(in_folders(spark, f"{root}/one", *rows), f"{root}/x", SPEC, staged=True)
    with_day(batch(spark, *rows), "ts").coalesce(1).write.parquet(f"{root}/mixed")
    upsert_table(spark.read.parquet(f"{root}/mixed"), f"{root}/y", SPEC, staged=True, stamp=STAMP)
    assert len(writes) == 2 and content(spark, f"{root}/x") == content(spark, f"{root}/y")


@pytest.mark.parametrize("fail_at", [1, 2])
def test_a_run_that_stops_between_rounds_is_put_right(spark, root, monkeypatch, fail_at):
    monkeypatch.setattr(tables, "ROUND_TASK_BYTES", 1)
    rows = in_folders(spark, f"{root}/one", (1, "2024-01-01", "a"), ("CAST(NULL AS INT)", "2024-01-01", "n"),
                      (2, "2024-01-02", "b"), (3, "2024-01-03", "c"))
    with monkeypatch.context() as broken:
        writes = noted_writes(broken, fail_at)
        with pytest.raises(RuntimeError):
            upsert_table(rows, root, SPEC, staged=True, stamp=STAMP)
        assert len(writes) == fail_at
    upsert_table(rows, root, SPEC, staged=True, stamp=STAMP)
    got = read_table(spark, SPEC.path(root)).select("id", "v").collect()
    assert sorted(map(tuple, got), key=str) == [(1, "a"), (2, "b"), (3, "c"), (None, "n")]


def test_tasks_fill_whole_waves():
    size = 8 * tables.TARGET_FILE_BYTES
    counts = [tables.range_count(size, tables.TARGET_FILE_BYTES, cores) for cores in (1, 4, 6, 8, 100)]
    assert counts == [8, 8, 12, 8, 8]
    assert tables.range_count(1000, tables.TARGET_FILE_BYTES, 6) == 1
    assert tables.range_count(9 * tables.LEAST_TASK_BYTES, tables.TARGET_FILE_BYTES, 6) == 9


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name}


def test_shuffle_files_go_with_their_query(spark, root):
    before, until = shuffle_files(spark), time.time() + 20
    with session.tidy(spark):
        spark.range(1000).repartition(3, "id").write.parquet(root)
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and read_table(spark, root).count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
