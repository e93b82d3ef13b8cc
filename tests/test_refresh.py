from __future__ import annotations

import pytest
from conftest import alert, forced, history

from novalake.plans import silver
from novalake.plans.refresh import (
    BRONZE_ALERT,
    CURRENT,
    SILVER,
    backfill,
    prepare_layers,
    refresh_day,
    upsert_detections,
)
from novalake.queries import lake
from novalake.session import drop_path, new_stage_path
from novalake.sources.landing import batch_of, valid_records
from novalake.sources.tables import read_table

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]
LIMIT = history(candid=None, diffmaglim=20.5)


def night(alerts):
    """Three nights: a history row of an earlier alert, changed reference values,
    repeated upper limits, missing ids, and one alert sent again a day later."""
    ps1 = {"nmtchps": 2, "objectidps1": 7, "sgmag1": 1.0, "objectidps2": 8}
    gaia = {"neargaia": 1.0, "neargaiabright": 2.0, "maggaia": 15.0, "maggaiabright": 14.0}
    return alerts(
        alert(1, date=DAYS[0], magnr=16.0, prv=[LIMIT, history(candid=90)], fp=[forced(), forced(pid=6)], **ps1),
        alert(2, date=DAYS[0], obj="B", rfid=None, **gaia),
        alert(3, date=DAYS[1], magnr=15.5, prv=[LIMIT, LIMIT, history(candid=1, jd=2460310.75)],
              fp=[forced(forcediffimflux=300.0)], **gaia),
        alert(4, date=DAYS[1], obj="B", rfid=None, ssdistnr=1.0, ssmagnr=17.0, ssnamenr="x"),
        alert(2, date=DAYS[1], obj="B", rfid=None, magpsf=18.0, **gaia),
        alert(None, date=DAYS[1], obj="C"),
        alert(5, date=DAYS[2], prv=[history(candid=3, jd=2460310.75), history(candid=90)]),
    )


def content(spark, root, spec):
    df = read_table(spark, spec.path(root)).drop("_created_ts")
    return sorted((tuple(r) for r in df.collect()), key=str), df.columns


SPECS = {"alert": BRONZE_ALERT} | SILVER


@pytest.fixture(scope="module", autouse=True)
def small_jobs(spark):
    """Many tiny jobs: compiling code for each would take longer than running it."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
                "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def lakes(spark):
    """The same nights once as a loop over days, once as one backfill."""
    from novalake.schemas import ALERT
    landing = night(lambda *rows: spark.createDataFrame(list(rows), ALERT)).cache()
    loop, whole = new_stage_path(spark, "loop"), new_stage_path(spark, "whole")
    for day in DAYS:
        refresh_day(spark, landing, loop, day)
    backfill(spark, landing, whole, DAYS[0], DAYS[-1])
    return landing, loop, whole


@pytest.mark.parametrize("name", SPECS)
def test_backfill_equals_the_loop_over_days(spark, lakes, name):
    _, loop, whole = lakes
    assert content(spark, loop, SPECS[name]) == content(spark, whole, SPECS[name])


def test_tables_after_the_loop(spark, lakes):
    _, loop, _ = lakes
    counts = {n: len(content(spark, loop, s)[0]) for n, s in SPECS.items()}
    assert counts == {
        "alert": 5, "crossmatch_gaia": 2, "crossmatch_ps1": 2, "crossmatch_ss": 1,
        "non_detection": 1, "forced_photometry": 2, "detection": 6,
        "reference": 3,  # a NULL image id never matches, so each night adds its own
    }


def test_history_overwrites_the_fuller_row_unless_told_not_to(spark, lakes):
    landing, loop, _ = lakes

    def stored(root):
        rows = read_table(spark, SILVER["detection"].path(root)).where("candid = 1").collect()
        return [(r.rfid, r.magnr) for r in rows]

    def detections(first, last, per=()):
        df = valid_records(batch_of(landing, first, last))
        return silver.detection(df, silver.reference(df, per), per, origin=CURRENT)

    assert stored(loop) == [(None, None)]
    kept, whole = new_stage_path(spark, "kept"), new_stage_path(spark, "kept")
    for day in DAYS[:2]:
        upsert_detections(detections(day, day), kept, (), keep_richer=True)
    upsert_detections(detections(DAYS[0], DAYS[1], silver.BATCH), whole, silver.BATCH, keep_richer=True)
    assert stored(kept) == stored(whole) == [(11, 16.0)]
    assert content(spark, kept, SILVER["detection"]) == content(spark, whole, SILVER["detection"])


def test_rerun_of_a_day_changes_nothing_but_null_keys(spark, lakes):
    landing, loop, _ = lakes
    before = {n: content(spark, loop, s)[0] for n, s in SPECS.items()}
    refresh_day(spark, landing, loop, DAYS[2])
    for name, spec in SPECS.items():
        assert content(spark, loop, spec)[0] == before[name], name


def test_layers_are_created_on_demand(spark):
    root = new_stage_path(spark, "layers")
    prepare_layers(spark, root, " my_bronze ")
    names = {r[0] for r in spark.sql("SHOW NAMESPACES").collect()}
    assert {"my_bronze", "silver"} <= names


def test_a_lake_of_the_queries_that_was_deleted_is_made_again(spark, monkeypatch):
    def fill(spark, landing, root, first, last):
        for spec in (BRONZE_ALERT, *SILVER.values()):
            spark.range(1).write.parquet(spec.path(root))

    monkeypatch.setattr(lake, "_lakes", {})
    monkeypatch.setattr(lake, "_landed", lambda spark, sf_dir: None)
    monkeypatch.setattr(lake, "backfill", fill)
    root = lake._filled_lake(spark, "x")
    assert lake._filled_lake(spark, "x") == root
    drop_path(spark, SILVER["reference"].path(root))
    assert lake._filled_lake(spark, "x") != root
