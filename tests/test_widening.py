import pytest
from pyspark.sql.types import StructType

from novalake.sources.compaction import compact_table
from novalake.sources.tables import append_evolving, read_evolved
from novalake.sources.widening import common_schema


@pytest.mark.parametrize("one, other, both", [
    ("a int, b float", "a bigint, b double", "a bigint, b double"),
    ("a bigint", "a smallint, c string", "a bigint, c string"),
    ("s struct<x: int>, l array<float>", "s struct<x: bigint, y: string>, l array<double>",
     "s struct<x: bigint, y: string>, l array<double>"),
])
def test_common_schema(spark, one, other, both):
    got = common_schema(StructType.fromDDL(one), StructType.fromDDL(other))
    assert got.simpleString() == StructType.fromDDL(both).simpleString()


@pytest.mark.parametrize("one, other", [("a string", "a int"), ("a bigint", "a double"), ("a struct<x: int>", "a int")])
def test_no_common_type(spark, one, other):
    with pytest.raises(ValueError, match="column a"):
        common_schema(StructType.fromDDL(one), StructType.fromDDL(other))


def test_three_appends_of_three_types(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for query in (
        "SELECT 1 AS id, CAST(0.5 AS FLOAT) AS v, named_struct('x', 7) AS s, 'p' AS kind",
        "SELECT 5000000000 AS id, 2.25D AS v, named_struct('x', 8L) AS s, 'p' AS kind",
        "SELECT CAST(3 AS SMALLINT) AS id, 1.5D AS v, named_struct('x', 9) AS s, 'q' AS kind",
    ):
        append_evolving(spark.sql(query), path, ["kind"])
    table = read_evolved(spark, path)
    assert dict(table.dtypes) == {"id": "bigint", "v": "double", "s": "struct<x:bigint>", "kind": "string"}
    rows = [(1, 0.5, 7, "p"), (3, 1.5, 9, "q"), (5000000000, 2.25, 8, "p")]
    assert sorted((r.id, r.v, r.s.x, r.kind) for r in table.collect()) == rows
    assert compact_table(spark, path, 1 << 20) == 1  # two files of one folder became one
    assert sorted((r.id, r.v, r.s.x, r.kind) for r in read_evolved(spark, path).collect()) == rows


def test_types_without_a_common_one_are_refused(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    append_evolving(spark.sql("SELECT 1 AS id"), path)
    append_evolving(spark.sql("SELECT 'a' AS id"), path)
    with pytest.raises(ValueError, match="column id"):
        read_evolved(spark, path)
