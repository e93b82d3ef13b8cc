"""Common types of a table's files, where later appends brought wider numbers.

Whole numbers widen to longer ones and float to double, inside structs and arrays too. Nothing else changes its type:
text and numbers have no common type, and a table never gets narrower.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

# The orders in which Parquet columns may be read as wider ones.
LADDERS = (("tinyint", "smallint", "int", "bigint"), ("float", "double"))
UNLIKE = "CANNOT_MERGE_SCHEMAS"


def common_type(one: DataType, other: DataType, name: str = "") -> DataType:
    """The narrowest type that holds both; ValueError if there is none."""
    if isinstance(one, StructType) and isinstance(other, StructType):
        return common_schema(one, other, f"{name}.")
    if isinstance(one, ArrayType) and isinstance(other, ArrayType):
        return ArrayType(common_type(one.elementType, other.elementType, f"{name}[]"), True)
    a, b = one.simpleString(), other.simpleString()
    if a == b:
        return one
    for ladder in LADDERS:
        if a in ladder and b in ladder:
            return one if ladder.index(a) > ladder.index(b) else other
    raise ValueError(f"column {name}: no common type of {a} and {b}")


def common_schema(one: StructType, other: StructType, within: str = "") -> StructType:
    """Columns of both, those of ``one`` first; names are compared without case, as Spark does."""
    theirs = {f.name.lower(): f for f in other}
    fields = []
    for field in one:
        match = theirs.pop(field.name.lower(), None)
        kind = common_type(field.dataType, match.dataType, within + field.name) if match else field.dataType
        fields.append(StructField(field.name, kind, True))
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in theirs.values()])


def merged_schema(spark: SparkSession, files: list[str]) -> StructType:
    """Schema of some files, oldest first, without partition columns. Files that agree are merged by Spark in one go, the others in halves: a
    change of type costs about the logarithm of the number of files."""
    try:
        reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
        return reader.parquet(*files).schema
    except (PySparkException, Py4JJavaError) as error:
        if UNLIKE not in str(error) or len(files) == 1:
            raise
    half = len(files) // 2
    return common_schema(merged_schema(spark, files[:half]), merged_schema(spark, files[half:]))


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    """All columns of all files, each in the common type of its files; NULL where a file lacks one.

    The driver gets the list of files, which it holds anyway, and reads the footers of all of them."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if UNLIKE not in str(error):
            raise
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    files = listed.load(path).select("path", F.col("modificationTime").alias("at")).orderBy("at", "path").collect()
    return spark.read.schema(merged_schema(spark, [f.path for f in files])).parquet(path)
