"""Queries that write tables on the way, in a session whose executors are processes of their own and that names no folder."""

from __future__ import annotations

import pytest
from compare import difference, duck
from pyspark import SparkContext
from pyspark.sql.conf import RuntimeConfig
from test_oracle import QUERIES, SF_DIR, SQL

from novalake import session
from novalake.queries import lake
from novalake.sources.files import fs_path

NAMES = [
    "append_evolve",
    "archive_scan",
    "bronze_alert",
    "bronze_append",
    "clustered_write",
    "checksum_files",
    "compact_appends",
    "detection",
    "create_empty_like",
    "first_run_create",
    "lake_bronze_alert",
    "lake_backfill",
    "lake_crossmatch_gaia",
    "lake_crossmatch_ss",
    "lake_crossmatch_ps1",
    "lake_forced_photometry",
    "lake_reference",
    "lake_non_detection",
    "lake_refresh_two_days",
    "landing_partition_scan",
    "landing_ingest",
    "landing_round_robin",
    "nightly_ingest",
    "layer_routing",
]


@pytest.fixture(scope="module")
def warehouse(tmp_path_factory):
    return tmp_path_factory.mktemp("warehouse")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.fixture(scope="module")
def lakes():
    """The lake of this module's session: made once."""
    return {}


@pytest.mark.parametrize("name", NAMES)
def test_query_without_named_folder(spark, con, warehouse, lakes, monkeypatch, name):
    given, theirs = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": f"file://{warehouse}"}, RuntimeConfig.get
    monkeypatch.setattr(RuntimeConfig, "get", lambda self, key, *rest: given[key] if key in given else theirs(self, key, *rest))
    monkeypatch.setattr(SparkContext, "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(spark.sparkContext, "master", "local-cluster[3,2,1024]")
    monkeypatch.setattr(session.tempfile, "mkdtemp", None)  # executors would have another one
    monkeypatch.setattr(lake, "_lakes", lakes)
    assert difference(spark, con, QUERIES[name], SQL[name], SF_DIR) is None
    assert (warehouse / "novalake-staged").is_dir()


# The same, with a named folder that is each machine's own.
NAMED_APART = [
    "archive_scan",
    "bronze_alert",
    "bronze_append",
    "clustered_write",
    "checksum_files",
    "compact_appends",
    "detection",
    "create_empty_like",
    "first_run_create",
    "landing_partition_scan",
    "landing_ingest",
    "landing_round_robin",
    "nightly_ingest",
    "layer_routing",
    "lake_bronze_alert",
    "lake_backfill",
    "lake_crossmatch_gaia",
    "lake_crossmatch_ss",
    "lake_crossmatch_ps1",
    "lake_forced_photometry",
    "lake_reference",
    "lake_non_detection",
    "lake_refresh_two_days",
]


@pytest.fixture(scope="module")
def own_lakes():
    return {}


@pytest.mark.parametrize("name", NAMED_APART)
@pytest.mark.filterwarnings("ignore:tables are staged in")
def test_query_with_named_folder_of_each_machine(spark, con, warehouse, own_lakes, monkeypatch, name):
    own = f"file://{warehouse}/own"
    given, theirs = {"spark.checkpoint.dir": own, "spark.sql.warehouse.dir": f"file://{warehouse}"}, RuntimeConfig.get
    tried = session._require_shared

    def refuse(spark, folder):
        if folder == own:
            raise RuntimeError(f"{folder} is a folder of each machine's own")
        tried(spark, folder)

    monkeypatch.setattr(RuntimeConfig, "get", lambda self, key, *rest: given[key] if key in given else theirs(self, key, *rest))
    monkeypatch.setattr(SparkContext, "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(spark.sparkContext, "master", "local-cluster[3,2,1024]")
    monkeypatch.setattr(session, "_seen_shared", {})
    monkeypatch.setattr(session, "_require_shared", refuse)
    monkeypatch.setattr(lake, "_lakes", own_lakes)
    assert difference(spark, con, QUERIES[name], SQL[name], SF_DIR) is None
    assert not (warehouse / "own").exists()


def test_staged_folder_goes_with_the_session(spark):
    path = session.new_stage_path(spark, "staged")
    fs, folder = fs_path(spark, path)
    assert not fs.exists(folder)
    spark.range(3).write.parquet(path)
    assert fs.cancelDeleteOnExit(folder)  # it was noted to be dropped
    session.drop_path(spark, path)
