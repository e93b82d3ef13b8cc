"""Alert-shaped records derived from order and line-item tables.

``candidate_alerts`` makes one alert per order. ``history_packets`` makes one
record per line item that carries one history and one forced-photometry
element; nothing is collected, however many line items an order has. Together
they are a complete set of nested alert records.

The field expressions are SQL over ``k`` (order key), ``c`` (customer key),
``n`` (line number) and the line-item columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from novalake.schemas import ALERT, CANDIDATE, FORCED, HISTORY, LANDING
from novalake.session import prepare
from novalake.sources.landing import dealt_by_date
from novalake.sources.tables import estimated_bytes

JD = "(2460310.5::DOUBLE + (k % 30) + (k % 8640) / 8640::DOUBLE)"
DAY = "(DATE '2024-01-01' + CAST(k % 30 AS INTEGER))"

CANDIDATE_SQL = {
    "candid": "k", "jd": JD, "fid": "k % 2 + 1", "pid": "k * 10",
    "rfid": "(c % 50) * 10 + k % 2 + 1",
    "isdiffpos": "CASE k % 6 WHEN 0 THEN ' T ' WHEN 1 THEN '1' WHEN 2 THEN 'f' "
    "WHEN 3 THEN '0' WHEN 5 THEN 'x' END",
    "distnr": "CASE WHEN k % 17 <> 0 THEN (k % 40) / 10::DOUBLE END",
    "magpsf": "14::DOUBLE + (k % 800) / 100::DOUBLE",
    "sigmapsf": "0.01::DOUBLE + (k % 20) / 100::DOUBLE",
    "magnr": "15::DOUBLE + (c % 600) / 100::DOUBLE",
    "sigmagnr": "0.01::DOUBLE + (c % 10) / 100::DOUBLE",
    "chinr": "CASE WHEN k % 3 <> 0 THEN (k % 100) / 100::DOUBLE END",
    "neargaia": "CASE WHEN k % 7 = 0 THEN -999::DOUBLE ELSE (k % 500) / 10::DOUBLE END",
    "neargaiabright": "CASE WHEN k % 9 = 0 THEN -999::DOUBLE ELSE (k % 900) / 10::DOUBLE END",
    "maggaia": "CASE WHEN k % 11 <> 0 THEN 12::DOUBLE + (k % 700) / 100::DOUBLE END",
    "maggaiabright": "10::DOUBLE + (k % 500) / 100::DOUBLE",
    "ssdistnr": "CASE WHEN k % 3 = 0 THEN CAST(k % 30 AS DOUBLE) ELSE -999::DOUBLE END",
    "ssmagnr": "CASE WHEN k % 3 = 0 THEN CAST(k % 5 + 16 AS DOUBLE) ELSE -999::DOUBLE END",
    "ssnamenr": "CASE WHEN k % 13 <> 0 THEN 'ast' || CAST(k % 100 AS STRING) END",
    "nmtchps": "k % 4",
    "objectidps1": "CASE WHEN k % 4 <> 0 THEN c * 10 + 1 END",
    "objectidps2": "CASE WHEN k % 4 >= 2 THEN CASE WHEN k % 5 = 0 THEN c * 10 + 1 ELSE c * 10 + 2 END END",
    "objectidps3": "CASE WHEN k % 4 >= 3 THEN c * 10 + 3 END",
    "jdstartref": "2459000.5::DOUBLE + c % 100",
    "jdendref": "2459200.5::DOUBLE + c % 100",
    "nframesref": "c % 30 + 15",
}
for _i in (1, 2, 3):
    for _j, _name in enumerate(("sgmag", "srmag", "simag", "szmag", "sgscore", "distpsnr")):
        _value = f"{16 + _j}::DOUBLE + ((k + {_i - 1}) % 300) / 100::DOUBLE"
        CANDIDATE_SQL[f"{_name}{_i}"] = (
            f"CASE WHEN k % 5 <> 0 THEN {_value} END" if _i == 1 else _value
        )

HISTORY_SQL = {
    "candid": "CASE n % 3 WHEN 1 THEN k + n * 30 WHEN 2 THEN 10000000 + k * 10 + n END",
    "jd": f"{JD} - n", "fid": "n % 2 + 1", "pid": "k * 10 + n",
    "diffmaglim": "19::DOUBLE + n / 10::DOUBLE",
    "isdiffpos": "CASE WHEN n % 2 = 0 THEN 't' ELSE 'f' END",
    "magpsf": "15::DOUBLE + ((k + n) % 600) / 100::DOUBLE",
    "sigmapsf": "0.05::DOUBLE", "distnr": "n / 10::DOUBLE",
}

FORCED_SQL = {
    "procstatus": "CASE WHEN l_returnflag = 'N' THEN '0' ELSE '61' END",
    "jd": f"{JD} - n", "fid": "n % 2 + 1", "pid": "k * 10 + n % 3",
    "rfid": "(c % 50) * 10 + n % 2 + 1",
    "forcediffimflux": "CASE WHEN n = 7 THEN -99999::DOUBLE ELSE l_extendedprice - 50000 END",
    "forcediffimfluxunc": "CASE WHEN l_quantity = 50 THEN -99999::DOUBLE ELSE l_quantity + 0.5::DOUBLE END",
    "magzpsci": "26::DOUBLE + l_tax",
    "magnr": "18::DOUBLE + l_discount * 10",
    "distnr": "CASE WHEN k % 17 <> 0 THEN (k % 40) / 10::DOUBLE END",
    "chinr": "CASE WHEN k % 23 = 0 THEN -99999::DOUBLE ELSE 1::DOUBLE END",
}

LISTED_FORCED_SQL = {
    "procstatus": "'0'", "jd": f"{JD} - 1", "fid": "k % 2 + 1", "pid": "k * 10",
    "rfid": "(c % 50) * 10 + k % 2 + 1",
    "forcediffimflux": "price - 100000",
    "forcediffimfluxunc": "1.5::DOUBLE + k % 9",
    "magzpsci": "26.25::DOUBLE", "magnr": "18::DOUBLE + k % 4",
}
OBJECT_ID = "'OBJ' || CAST(c AS STRING)"

# Fields without an expression are constants.
DEFAULTS = {"string": "'v1'", "bigint": "7", "int": "3", "double": "0.5", "float": "0.5::DOUBLE"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as it is."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _record_sql(values: dict[str, str], schema: StructType) -> str:
    fields = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        fields.append(f"'{field.name}', CAST({values.get(field.name, DEFAULTS[kind])} AS {kind})")
    return f"named_struct({', '.join(fields)})"


def _record(values: dict[str, str], schema: StructType) -> Column:
    return F.expr(_record_sql(values, schema))


def _nothing(name: str) -> Column:
    return F.lit(None).cast(ALERT[name].dataType).alias(name)


def candidate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c")
    return orders.select(
        F.expr(OBJECT_ID).alias("objectId"),
        F.col("k").alias("candid"),
        _record(CANDIDATE_SQL, CANDIDATE).alias("candidate"),
        _nothing("prv_candidates"),
        _nothing("fp_hists"),
        F.expr(DAY).alias("observation_date"),
    )


def history_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c")
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS k", "CAST(l_linenumber AS BIGINT) AS n", "l_returnflag", "l_extendedprice",
        "l_quantity", "l_tax", "l_discount",
    )
    return items.join(orders, "k").select(
        F.expr(OBJECT_ID).alias("objectId"),
        F.lit(None).cast("bigint").alias("candid"),
        _nothing("candidate"),
        F.array(_record(HISTORY_SQL, HISTORY)).alias("prv_candidates"),
        F.array(_record(FORCED_SQL, FORCED)).alias("fp_hists"),
        F.expr(DAY).alias("observation_date"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_alerts(spark, sf_dir).unionByName(history_packets(spark, sf_dir))


def listed_alerts(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One alert per order, each with a list of four history elements (one twice).

    ``dealt`` brings the nights together for :func:`write_landing` while the rows are still those of the orders,
    a hundredth of an alert in bytes.
    """
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "o_totalprice AS price", f"{DAY} AS observation_date"
    )
    if dealt:
        orders = dealt_by_date(orders, estimated_bytes(_listed(orders)), "k")
    return _listed(orders)


def _listed(orders: DataFrame) -> DataFrame:
    def element(n: int) -> Column:
        return _record({name: re.sub(r"\bn\b", f"{n}L", sql) for name, sql in HISTORY_SQL.items()}, HISTORY)

    return orders.select(
        F.expr(OBJECT_ID).alias("objectId"),
        F.col("k").alias("candid"),
        _record(CANDIDATE_SQL, CANDIDATE).alias("candidate"),
        F.array(*map(element, (1, 2, 3, 2))).alias("prv_candidates"),
        F.array(_record(LISTED_FORCED_SQL, FORCED)).alias("fp_hists"),
        "observation_date",
    )


def landing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as raw alert records with image payloads; some lack the id."""
    pages = table(spark, sf_dir, "pages").selectExpr(
        "page_id AS k", "page_id % 97 AS c", "CAST(1 AS BIGINT) AS n", "html", "url"
    )

    def stamp(body: str, present: str) -> Column:
        return F.expr(
            f"CASE WHEN {present} THEN named_struct('fileName', 'img', "
            f"'stampData', encode({body}, 'UTF-8')) END"
        )

    return pages.select(
        F.expr("'PAGE' || CAST(k AS STRING)").alias("objectId"),
        F.expr("CASE WHEN k % 19 <> 0 THEN k END").alias("candid"),
        _record(CANDIDATE_SQL, CANDIDATE).alias("candidate"),
        F.array(_record(HISTORY_SQL, HISTORY), _record(HISTORY_SQL, HISTORY)).alias("prv_candidates"),
        _nothing("fp_hists"),
        stamp("html", "k % 7 <> 0").alias("cutoutScience"),
        stamp("url", "k % 3 <> 0 AND k % 7 <> 0").alias("cutoutTemplate"),
        stamp("reverse(url)", "k % 5 = 0 AND k % 7 <> 0").alias("cutoutDifference"),
        F.expr(DAY).alias("observation_date"),
    ).select(*(F.col(f.name).cast(f.dataType) if f.name.startswith("cutout") else f.name
               for f in LANDING.fields))
