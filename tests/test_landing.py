from __future__ import annotations

import hashlib

from conftest import alert
from pyspark.sql import functions as F

from novalake.fixtures import listed_alerts
from novalake.plans.bronze import append_bronze, bronze_job, ingest_landing, ingest_night
from novalake.schemas import ALERT, LANDING
from novalake.session import new_stage_path
from novalake.sources.landing import (
    DEALT_BYTES,
    batch_of,
    dealt_by_date,
    read_archive,
    read_landing,
    record_counts,
    skipped_files,
    valid_records,
    write_landing,
)
from novalake.sources.manifest import hash_files, read_files, read_manifest, verify_checksums
from novalake.sources.payload import payload_columns, payload_rows, with_payload_key
from novalake.sources.tables import read_evolved


def raw(spark, *rows):
    """rows: (candid, science, template, difference) bytes or None."""
    def stamp(b):
        return None if b is None else ("f", b)

    values = [
        (*alert(candid)[:5], stamp(s), stamp(t), stamp(d), alert(1)[5]) for candid, s, t, d in rows
    ]
    return spark.createDataFrame(values, LANDING)


def test_payload_split(spark):
    df = raw(spark, (1, b"s", b"t", None), (2, None, None, None), (None, b"x", None, None))
    assert [c for c, _ in payload_columns(df)] == ["cutoutScience", "cutoutTemplate", "cutoutDifference"]
    got = {(r.candid, r.cutout_type): bytes(r.stamp_data) for r in payload_rows(df).collect()}
    assert got == {(1, "cutoutScience"): b"s", (1, "cutoutTemplate"): b"t"}
    keys = {r.object_key for r in with_payload_key(payload_rows(df), "cutouts").collect()}
    assert keys == {"cutouts/1/1_science.fits.gz", "cutouts/1/1_template.fits.gz"}
    counts = record_counts(df).first()
    assert (counts.n_records, counts.n_without_candid, counts.n_kept, counts.n_without_payload) == (3, 1, 2, 1)
    assert valid_records(df).count() == 2


def test_ingest_replaces_a_date_and_prunes_by_it(spark):
    path, images = new_stage_path(spark, "landing"), new_stage_path(spark, "images")
    df = raw(spark, (1, b"s", None, None), (2, None, None, None), (None, b"x", None, None))
    for _ in range(2):
        counts = ingest_landing(df, path, images).first()
    assert counts.n_kept == 2
    landing = read_landing(spark, path, "parquet", ALERT)
    assert landing.count() == 2 and spark.read.parquet(images).count() == 1
    day = batch_of(landing, "2024-01-01")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(observation_date" in plan
    assert day.count() == 2 and batch_of(landing, "2024-01-02").count() == 0


def test_rows_dealt_by_date_are_not_shuffled_as_records(spark):
    path = new_stage_path(spark, "landing")
    ids = spark.range(1200).select("id", F.expr("DATE '2024-01-01' + CAST(id % 1200 >= 1000 AS INT)").alias("observation_date"))
    dealt = dealt_by_date(ids, 4 * DEALT_BYTES, "id")
    assert dealt.rdd.getNumPartitions() == 4
    records = dealt.select(F.col("id").alias("candid"), F.struct("id").alias("candidate"), "observation_date")
    write_landing(records, path, dealt=True)
    files = spark.read.parquet(path).groupBy("observation_date", "_metadata.file_path").count().collect()
    assert sum(f["count"] for f in files) == 1200 and len(files) <= 5  # the hot date is split, small ones share a task
    assert sum(str(f.observation_date) == "2024-01-01" for f in files) >= 3


def test_listed_alerts_are_the_same_when_dealt(spark):
    one, other = (listed_alerts(spark, "/root/testdata/sf0.001", dealt) for dealt in (False, True))
    assert one.schema == other.schema and one.count() == other.count() > 0
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_round_robin_fills_files_evenly(spark):
    path = new_stage_path(spark, "landing")
    rows = spark.createDataFrame([alert(1, obj="hot")], ALERT).crossJoin(spark.range(400)).drop("id")
    write_landing(rows, path, files=4)
    sizes = [r["count"] for r in read_landing(spark, path, "parquet", ALERT)
             .groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 8  # copies of one alert, spread evenly


def test_archive_scan_is_recursive(spark, tmp_path):
    for i, name in enumerate(["a", "b/c", "b/d/e"]):
        spark.range(i, i + 1).write.parquet(str(tmp_path / name))
    (tmp_path / "b" / "note.txt").write_text("not a record")
    got = read_archive(spark, f"file://{tmp_path}", "parquet", glob="*.parquet")
    assert sorted(r.id for r in got.collect()) == [0, 1, 2]


def test_unreadable_files_are_skipped_and_named(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "x"))
    (tmp_path / "x" / "part-bad.parquet").write_bytes(b"this is not parquet at all")
    df = read_landing(spark, f"file://{tmp_path}/x", "parquet", spark.range(1).schema, tolerant=True)
    assert df.count() == 100
    skipped = skipped_files(df, spark, f"file://{tmp_path}/x", "part-*.parquet")
    assert [r.path.rsplit("/", 1)[1] for r in skipped.collect()] == ["part-bad.parquet"]


def test_checksums_of_real_files(spark, tmp_path):
    data = tmp_path / "data"
    (data / "sub").mkdir(parents=True)
    bodies = {"a.avro": b"aaa", "b.avro": b"\x00\x01", "c.avro": b"ccc"}
    for name, body in bodies.items():
        (data / "sub" / name).write_bytes(body)
    md5 = {n: hashlib.md5(b).hexdigest() for n, b in bodies.items()}
    manifest = tmp_path / "MD5SUMS"
    manifest.write_text(
        f"{'0' * 32}  old/a.avro\n\nlonely\n  {md5['a.avro']}   x/y z/a.avro \n{'1' * 32} b.avro\n"
    )
    parsed = {r.filename: r.md5 for r in read_manifest(spark, f"file://{manifest}").collect()}
    assert parsed == {"a.avro": md5["a.avro"], "b.avro": "1" * 32}  # the later line counts
    checked = verify_checksums(read_files(spark, f"file://{data}", "*.avro"), read_manifest(spark, f"file://{manifest}"))
    assert {r.filename: r.status for r in checked.collect()} == {
        "a.avro": "match", "b.avro": "mismatch", "c.avro": "no expected hash",
    }


def test_checksums_of_files_beyond_what_a_row_holds(spark, tmp_path):
    folder = tmp_path / "a b%20"
    folder.mkdir()
    (folder / "small 1%.avro.gz").write_bytes(b"\x1f\x8b not unpacked")
    with (folder / "large.avro").open("wb") as file:  # zeros without room on disk, then two bytes
        file.seek(2**31)
        file.write(b"ab")
    whole = hashlib.md5()
    for _ in range(2**11):
        whole.update(bytes(2**20))
    whole.update(b"ab")
    got = {r.path.rsplit("/", 1)[1]: r.md5 for r in hash_files(spark, f"file://{folder}").collect()}
    assert got == {"small 1%.avro.gz": hashlib.md5(b"\x1f\x8b not unpacked").hexdigest(), "large.avro": whole.hexdigest()}


def test_checksums_of_a_store_that_only_spark_reads(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.avro").write_bytes(b"aaa")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.sums.link./in", f"file://{tmp_path}")
    assert [tuple(r) for r in hash_files(spark, "viewfs://sums/in/x").collect()] == [
        ("viewfs://sums/in/x/a.avro", hashlib.md5(b"aaa").hexdigest())]


def test_bronze_append_keeps_duplicates_and_new_columns(spark):
    path = new_stage_path(spark, "bronze")
    df = spark.createDataFrame([alert(1)], ALERT).select("objectId", "candid", "candidate")
    append_bronze(df, path)
    append_bronze(df.withColumn("publisher", F.lit("p")), path)
    rows = read_evolved(spark, path).collect()
    assert sorted(str(r.publisher) for r in rows) == ["None", "p"]
    assert {str(r.observation_day) for r in rows} == {"2024-01-01"}
    assert {str(r.observation_timestamp) for r in rows} == {"2024-01-01 06:00:00"}


def test_night_from_archive_to_landing(spark, tmp_path):
    df = raw(spark, (1, b"s", b"t", None), (2, None, None, None), (None, b"x", None, None))
    df.drop("observation_date").repartition(3).write.parquet(str(tmp_path / "extracted" / "deep"))
    alerts, images = f"file://{tmp_path}/alerts", f"file://{tmp_path}/images"
    summary = ingest_night(
        spark, f"file://{tmp_path}/extracted", "2024-02-01", alerts, images, "parquet", "*.parquet",
    ).first()
    listed = len(list((tmp_path / "extracted").glob("**/*.parquet")))
    assert (summary.n_files, summary.n_records, summary.skipped) == (listed, 3, False)
    assert summary.destination.endswith("alerts/observation_date=2024-02-01")
    landing = read_landing(spark, alerts, "parquet")
    assert {(r.candid, str(r.observation_date)) for r in landing.collect()} == {(1, "2024-02-01"), (2, "2024-02-01")}
    assert not [c for c in landing.columns if c.startswith("cutout")]
    keys = {r.object_key for r in spark.read.parquet(images).collect()}
    assert keys == {"cutouts/1/1_science.fits.gz", "cutouts/1/1_template.fits.gz"}


def test_bronze_job_takes_any_format(spark, tmp_path):
    spark.createDataFrame([alert(1)], ALERT).drop("observation_date").write.orc(str(tmp_path / "in"))
    bronze_job(spark, f"file://{tmp_path}/in", "orc", f"file://{tmp_path}/bronze")
    row = read_evolved(spark, f"file://{tmp_path}/bronze").first()
    assert row.candid == 1 and str(row.observation_day) == "2024-01-01" and row.candidate.magpsf == 17.0
