"""Run registered queries beside their SQL twins and compare values as multisets.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, con, sf_dir: str, query, sql: str | None) -> list[str]:
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return [] if rows else ["no rows"]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    have, want = bag(df.columns, rows), bag(names, expected)
    if have == want:
        return []
    return [f"rows {len(rows)} vs {len(expected)}", f"only spark {list((have - want).items())[:2]}",
            f"only sql {list((want - have).items())[:2]}"]


def main() -> None:
    import __spark_entry__ as entry
    from millrace.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                     "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = database(sf_dir), entry.oracle_sql(), 0
    wanted = sys.argv[2:]
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, query, sqls.get(name))
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        mark = "FAIL" if found else ("ok" if name in sqls else "ok (rows only)")
        print(f"{name:34s} {time.time() - start:6.2f}s {mark}", *found, sep="\n      " if found else " ", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
