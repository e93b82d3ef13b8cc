"""Tables built at the same time, and runs that are taken up again."""

from __future__ import annotations

import threading
import time

import pytest
from conftest import alert, forced, history

from novalake.plans import refresh
from novalake.plans.flow import TablesFailed, build_all, levels
from novalake.plans.refresh import BRONZE_ALERT, NEEDS, SILVER, backfill
from novalake.schemas import ALERT
from novalake.session import new_stage_path
from novalake.sources import tables
from novalake.sources.ledger import Ledger, finished_runs, fingerprint
from novalake.sources.tables import TableSpec, read_table, table_exists, upsert_table

DATES = ("2024-01-01", "2024-01-02")
SPECS = {"alert": BRONZE_ALERT} | SILVER


def test_levels_of_the_lake():
    assert levels(NEEDS) == [
        ["alert"],
        ["crossmatch_gaia", "crossmatch_ps1", "crossmatch_ss", "forced_photometry", "non_detection", "reference"],
        ["detection"],
    ]
    with pytest.raises(ValueError):
        levels({"a": ("b",), "b": ("a",)})


def test_independent_steps_overlap_and_needs_are_kept(spark):
    order, met = [], threading.Barrier(2, timeout=20)

    def meet(name):
        met.wait()  # passes only if both are running
        order.append(name)

    build_all(spark, {"a": (), "b": (), "c": ("a", "b")}, {
        "a": lambda: meet("a"), "b": lambda: meet("b"), "c": lambda: order.append("c")}, at_once=2)
    assert sorted(order[:2]) == ["a", "b"] and order[2] == "c"


def test_a_failing_table_stops_only_its_dependants(spark):
    built = []

    def fail():
        raise OSError("disk full")

    needs = {"a": (), "b": ("a",), "c": ("b",), "d": ("a",), "e": ("d",), "f": ("c", "e")}
    steps = {n: (lambda n=n: built.append(n)) for n in needs} | {"b": fail}
    with pytest.raises(TablesFailed, match="disk full") as caught:
        build_all(spark, needs, steps)
    assert sorted(built) == ["a", "d", "e"]
    assert list(caught.value.failed) == ["b"] and caught.value.skipped == ["c", "f"]


def test_steps_must_fit_the_dependencies(spark):
    with pytest.raises(ValueError, match="differ"):
        build_all(spark, {"a": ()}, {})


def test_jobs_run_in_pools_of_their_own(spark):
    pools = {}

    def step(name):
        time.sleep(0.01)
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    build_all(spark, {"a": (), "b": ()}, {n: (lambda n=n: step(n)) for n in "ab"})
    assert pools == {"a": "a", "b": "b"}


@pytest.fixture
def small_jobs(spark):
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
                "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def landed(spark, *more):
    rows = [
        alert(1, date=DATES[0], prv=[history(candid=90), history(candid=None, diffmaglim=20.5)], fp=[forced()],
              nmtchps=2, objectidps1=7, neargaia=1.0, maggaia=15.0, neargaiabright=2.0, maggaiabright=14.0),
        alert(2, obj="B", date=DATES[0], rfid=None),
        alert(3, date=DATES[1], prv=[history(candid=1)], fp=[forced(forcediffimflux=300.0)]),
        alert(4, obj="B", date=DATES[1], rfid=None),  # a NULL image id matches nothing
        *more,
    ]
    path = new_stage_path(spark, "landing")
    spark.createDataFrame(rows, ALERT).write.partitionBy("observation_date").parquet(path)
    return spark.read.schema(ALERT).parquet(path)


def content(spark, root):
    out = {}
    for name, spec in SPECS.items():
        if table_exists(spark, spec.path(root)):
            rows = read_table(spark, spec.path(root), ALERT).drop("_created_ts").collect()
            out[name] = sorted(map(str, rows))
    return out


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_stopped_backfill_goes_on_and_gives_the_same_lake(spark, small_jobs, monkeypatch, when):
    landing, whole, root = landed(spark), new_stage_path(spark, "whole"), new_stage_path(spark, "lake")
    backfill(spark, landing, whole, *DATES)
    written = []

    def stopping(source, at, spec, **more):
        if when == "after":
            upsert_table(source, at, spec, **more)
        if spec.name == "reference":  # stops before its write, or after it and before the mark
            raise RuntimeError("stopped")
        if when == "before":
            upsert_table(source, at, spec, **more)

    def noting(source, at, spec, **more):
        written.append(spec.name)
        upsert_table(source, at, spec, **more)

    with monkeypatch.context() as broken:
        broken.setattr(refresh, "upsert_table", stopping)
        with pytest.raises(TablesFailed) as caught:
            backfill(spark, landing, root, *DATES)
    assert list(caught.value.failed) == ["reference"] and caught.value.skipped == ["detection"]
    assert "detection" not in content(spark, root) and finished_runs(spark, root) == []
    with monkeypatch.context() as watched:
        watched.setattr(refresh, "upsert_table", noting)
        backfill(spark, landing, root, *DATES)
    assert sorted(written) == ["detection", "reference"]
    assert content(spark, root) == content(spark, whole)
    assert len(finished_runs(spark, root)) == 1


def test_a_finished_backfill_is_run_again_in_full(spark, small_jobs, monkeypatch):
    landing, root, written = landed(spark), new_stage_path(spark, "lake"), []

    def noting(source, at, spec, **more):
        written.append(spec.name)
        upsert_table(source, at, spec, **more)

    monkeypatch.setattr(refresh, "upsert_table", noting)
    backfill(spark, landing, root, *DATES)
    backfill(spark, landing, root, *DATES, at_once=1)
    assert sorted(written) == sorted([*SPECS] * 2) and len(finished_runs(spark, root)) == 2


def test_other_files_are_another_run(spark):
    one, other = landed(spark), landed(spark, alert(9, date=DATES[1]))
    keys = ["observation_date", "candid"]
    assert fingerprint(one, keys) == fingerprint(one, keys) != fingerprint(other, keys)
    assert fingerprint(one.limit(2), keys) != fingerprint(one.limit(3), keys)  # no scan: the keys tell


def test_a_broken_write_is_replaced_whatever_its_keys(spark, monkeypatch):
    spec, root = TableSpec("silver", "t", ("id",), ("part",), ("id",)), new_stage_path(spark, "lake")
    ledger = Ledger(spark, root, "run")
    old = spark.sql("SELECT * FROM VALUES (1, 'a', 0), (CAST(NULL AS INT), 'b', 0), (2, 'c', 1) t(id, v, part)")
    new = spark.sql("SELECT * FROM VALUES (1, 'A', 0), (CAST(NULL AS INT), 'B', 1) t(id, v, part)")
    upsert_table(old, root, spec)
    for _ in range(3):  # as if the mark after the write was lost twice
        upsert_table(new, root, spec, stamp=ledger.begin("t"))
    rows = sorted(map(str, read_table(spark, spec.path(root)).select("id", "v", "part").collect()))
    assert rows == sorted(["Row(id=1, v='A', part=0)", "Row(id=None, v='b', part=0)", "Row(id=2, v='c', part=1)",
                           "Row(id=None, v='B', part=1)"])
    assert tables.table_exists(spark, spec.path(root)) and not ledger.is_done("t")
    ledger.finish("t")
    assert Ledger(spark, root, "run").is_done("t")


def held_labels(spark, monkeypatch, landing):
    """What a backfill stages before it builds tables, and whether its shuffle files go with each query."""
    labels, theirs, key = [], refresh.held, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def noting(df, label):
        labels.append(label)
        return theirs(df, label)

    with monkeypatch.context() as watched:
        watched.setattr(refresh, "held", noting)
        watched.setattr(refresh, "build_all", lambda *_: labels.append(spark.conf.get(key)))
        backfill(spark, landing, new_stage_path(spark, "lake"), *DATES)
    return labels


def test_parquet_landing_files_are_read_where_they_lie(spark, monkeypatch):
    landing = landed(spark)
    assert held_labels(spark, monkeypatch, landing) == ["true"]
    assert held_labels(spark, monkeypatch, landing.localCheckpoint()) == ["backfill", "true"]
    twice = landed(spark, alert(2, obj="B", date=DATES[0], rfid=None))
    assert held_labels(spark, monkeypatch, twice) == ["backfill", "true"]


def test_landing_read_where_it_lies_gives_the_same_lake(spark, small_jobs, monkeypatch):
    landing, direct, staged = landed(spark), new_stage_path(spark, "direct"), new_stage_path(spark, "staged")
    monkeypatch.setattr(tables, "ROUND_TASK_BYTES", 1)  # and in rounds
    backfill(spark, landing, direct, *DATES)
    monkeypatch.undo()
    backfill(spark, landing.localCheckpoint(), staged, *DATES)
    assert content(spark, direct) == content(spark, staged)
