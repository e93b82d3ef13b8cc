"""Side-by-side run of the registered queries and their SQL in DuckDB.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def bag(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(_plain(v) for v in row) for row in zip(*columns)) if names else Counter()


def kinds(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def difference(spark, con, query, sql, sf_dir) -> str | None:
    ours = query(spark, sf_dir).toArrow()
    theirs = con.execute(sql).to_arrow_table()
    if kinds(ours) != kinds(theirs):
        a, b = kinds(ours), kinds(theirs)
        return f"schema: {[(k, a.get(k), b.get(k)) for k in sorted(a.keys() | b.keys()) if a.get(k) != b.get(k)]}"
    mine, other = bag(ours), bag(theirs)
    if mine != other:
        left, right = mine - other, other - mine
        names = sorted(ours.column_names)
        detail = ""
        if left and right:
            x = next(iter(left))
            y = min(right, key=lambda r: sum(p != q for p, q in zip(x, r)))
            detail = str([(n, p, q) for n, p, q in zip(names, x, y) if p != q][:6])
        return (f"rows: {ours.num_rows} / {theirs.num_rows}, only ours {sum(left.values())}, "
                f"only SQL {sum(right.values())} {detail}")
    return None


def main():
    import __spark_entry__ as driver
    from novalake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, {
        "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false",
    })
    con = duck(sf_dir)
    sqls, failed = driver.oracle_sql(), 0
    for name, query in driver.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in sqls:
                problem = difference(spark, con, query, sqls[name], sf_dir)
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # shown per query, so that one failure hides no other
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}")
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
