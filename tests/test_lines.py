from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from novalake.session import new_stage_path
from novalake.sources.lines import good_records, ingest_lines, read_lines, rejects

SCHEMA = (StructType().add("a", LongType()).add("b", StringType())
          .add("n", StructType().add("p", ArrayType(IntegerType()))))
LINES = {
    '{"a":1,"b":"x"}': None, ' {"a":2,"n":{"p":[1]}} ': None, '{"a":3,"other":[9]}': None,
    '{"a":1,"b":"x"': "torn", '{"a":1}{"a":2}': "torn", '{"a":1},{"a":2}': "torn", '{"a":1}]': "torn", '{"a":1}}': "torn",
    '{"a":1}],[{"a":2}': "torn", '{"a":1},"x":{"a":2}': "torn", '{"a":1} x': "torn", "text": "torn", '{"a":1,"a":2}': "torn",
    "[1]": "no record", "5": "no record", "null": "no record", '[{"a":1}]': "no record", '"{}"': "no record",
    '{"a":"q"}': "wrong type", '{"a":1.5}': "wrong type", '{"a":8,"n":{"p":"bad"}}': "wrong type",
    "{}": "no key", '{"b":"z"}': "no key", '{"a":null}': "no key",
}


def written(spark, lines):
    folder = new_stage_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(2).write.text(folder)
    return read_lines(spark, folder, SCHEMA, "a", "part-*")


def test_each_reason(spark):
    got = written(spark, [*LINES, "", "  "])
    assert {r.line: r.reason for r in got.select("line", "reason").collect()} == LINES
    assert sorted(r.a for r in good_records(got).collect()) == [1, 2, 3]
    # the verdict is the same however few columns are asked for
    assert good_records(got).count() == good_records(got).select("b").count() == 3
    assert rejects(got).count() == len(LINES) - 3


def test_both_sides_are_written_and_counted(spark):
    kept, refused = new_stage_path(spark, "kept"), new_stage_path(spark, "rejects")
    counts = ingest_lines(written(spark, [*LINES] * 2), kept, refused).first().asDict()
    assert counts == {"n_kept": 6, "n_torn": 20, "n_no_record": 10, "n_wrong_type": 6, "n_no_key": 6}
    assert spark.read.parquet(refused).where("file LIKE '%part-%'").count() == 42
    counts = ingest_lines(written(spark, ['{"a":1}']), kept, refused).first().asDict()
    assert counts.pop("n_kept") == 1 and not any(counts.values())
    counts = ingest_lines(written(spark, ["", " "]), kept, refused).first().asDict()
    assert not any(counts.values())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='{}[],:"a1 ', max_size=12), min_size=1, max_size=60))
def test_a_line_is_kept_or_rejected_as_a_plain_parser_says(spark, lines):
    def kind(line):
        try:
            pairs = json.loads(line, object_pairs_hook=lambda p: p if len({k for k, _ in p}) == len(p) else 1 / 0)
        except (ValueError, ZeroDivisionError):
            return "torn"
        if not line.strip().startswith("{"):
            return "no record"
        a = dict(pairs).get("a")
        if a is not None and (isinstance(a, bool) or not isinstance(a, int)):
            return "wrong type"
        return "no key" if a is None else None

    got = {r.line: r.reason for r in written(spark, lines).select("line", "reason").collect()}
    assert got == {line: kind(line) for line in lines if line.strip(" ")}


@pytest.mark.parametrize("empty", [[], [""]])
def test_nothing_to_read(spark, empty):
    assert written(spark, empty or [""]).count() == 0
