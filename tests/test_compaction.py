from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from novalake.session import new_stage_path
from novalake.sources import compaction
from novalake.sources.compaction import COMPACTING, compact_table, finish_compactions, packed_bins
from novalake.sources.files import fs_path
from novalake.sources.tables import TableSpec, append_evolving, read_evolved, read_table, upsert_table

TARGET = 1 << 20


@pytest.fixture
def path(spark):
    """Six appends to folders with a NULL, a numeric-looking and a special name; later ones have one column more."""
    path = new_stage_path(spark, "small files")
    for n in range(6):
        rows = spark.range(n * 100, n * 100 + 100).select(
            "id", F.element_at(F.array(F.lit("01"), F.lit("a b=%{c}"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("kind"))
        append_evolving(rows.withColumn("extra", F.col("id") * 2) if n > 3 else rows, path, ["kind"])
    return path


def content(spark, path):
    return sorted((r.id, str(r.kind), r.extra) for r in read_evolved(spark, path).collect())


def files(spark, path):
    found = read_table(spark, path).select("_metadata.file_path", "_metadata.file_size").distinct().collect()
    return sorted((r[0], r[1]) for r in found)


def leftovers(spark, path):
    fs, folder = fs_path(spark, f"{path}/{COMPACTING}")
    return fs.exists(folder)


def test_small_files_become_one_a_folder(spark, path):
    before, folders = content(spark, path), {f.rsplit("/", 1)[0] for f, _ in files(spark, path)}
    assert len(files(spark, path)) == 18
    assert compact_table(spark, path, TARGET, ["id", "kind"]) == 15
    assert content(spark, path) == before
    assert {f.rsplit("/", 1)[0] for f, _ in files(spark, path)} == folders and len(files(spark, path)) == 3
    assert not leftovers(spark, path)
    for file, _ in files(spark, path):
        ids = [r.id for r in spark.read.parquet(fs_path(spark, path)[1].toString()).where(
            F.col("_metadata.file_path") == file).select("id").collect()]
        assert ids == sorted(ids)
    kept = files(spark, path)
    assert compact_table(spark, path, TARGET) == 0 and files(spark, path) == kept


def test_files_of_half_the_target_stay(spark, path):
    kept = files(spark, path)
    assert compact_table(spark, path, 2 * min(size for _, size in kept)) == 0
    assert files(spark, path) == kept


@pytest.mark.parametrize("stops_at", ["write_note", "_move_bin", "second_move", "delete"])
def test_a_stopped_compaction_loses_and_doubles_nothing(spark, path, monkeypatch, stops_at):
    before, calls, move = content(spark, path), [], compaction._move_bin

    def stop(*args):
        calls.append(args)
        if stops_at == "second_move" and len(calls) == 1:
            return move(*args)
        if stops_at == "delete":  # the new file is in its place, the old ones too
            monkeypatch.setattr(compaction, "fs_uri", lambda s, uri: (_ for _ in ()).throw(RuntimeError("stopped"))
                                if uri == args[3][0] else original(s, uri))
            return move(*args)
        raise RuntimeError("stopped")

    original = compaction.fs_uri
    with monkeypatch.context() as broken:
        broken.setattr(compaction, "write_note" if stops_at == "write_note" else "_move_bin", stop)
        with pytest.raises(RuntimeError):
            compact_table(spark, path, TARGET)
    monkeypatch.setattr(compaction, "fs_uri", original)
    assert leftovers(spark, path)
    finish_compactions(spark, path)
    assert content(spark, path) == before and not leftovers(spark, path)
    assert len(files(spark, path)) == (18 if stops_at == "write_note" else 3)


def test_an_upsert_finishes_what_was_left(spark, monkeypatch):
    root, spec = new_stage_path(spark, "lake"), TableSpec("silver", "t", ("id",), ("kind",), key_fixes_partition=True)
    rows = spark.range(20).select("id", F.lit("x").alias("kind"), F.lit("old").alias("v"))
    for part in (rows.where("id < 10"), rows.where("id >= 10")):
        append_evolving(part.withColumn("_created_ts", F.current_timestamp()), spec.path(root), ["kind"])
    with monkeypatch.context() as broken:
        broken.setattr(compaction, "_move_bin", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            compact_table(spark, spec.path(root), TARGET)
    upsert_table(rows.where("id = 3").withColumn("v", F.lit("new")), root, spec)
    got = {r.id: r.v for r in read_table(spark, spec.path(root)).collect()}
    assert got == {n: "new" if n == 3 else "old" for n in range(20)}
    assert not leftovers(spark, spec.path(root))


@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 150)), max_size=40))
def test_bins(drawn):
    listed = [(f"{folder}/{n}", size) for n, (folder, size) in enumerate(drawn)]
    sizes, bins = dict(listed), packed_bins(listed, 100)
    used = [name for group in bins for name in group]
    assert len(used) == len(set(used)) and all(2 * sizes[n] < 100 for n in used)
    for group in bins:
        assert len(group) > 1 and sum(sizes[n] for n in group) <= 100 and len({n[0] for n in group}) == 1
    for folder in "ab":  # no two files left over that would fit together
        left = [s for n, s in listed if n[0] == folder and n not in used and 2 * s < 100]
        assert len(left) <= 1
