"""Runs catalog queries beside their SQL and reports differences.

    python tests/oracle_check.py [data folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("n", value.normalize())
    if isinstance(value, bool) or value is None:
        return ("b", str(value))
    if isinstance(value, int):
        return ("n", decimal.Decimal(value).normalize())
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("f", repr(value))
    if isinstance(value, datetime.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("d", value.isoformat())
    return ("s", str(value))


def kind(type_name):
    text = str(type_name).lower()
    for word, group in (("int", "integer"), ("long", "integer"), ("double", "float"), ("decimal", "decimal")):
        if word in text:
            return group
    for word in ("timestamp", "date", "bool", "string", "varchar", "binary", "blob"):
        if word in text:
            return {"varchar": "string", "blob": "binary"}.get(word, word)
    return text


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def compare(spark, con, sf_dir, query):
    """Differences between a query and its SQL, as text; none when they agree."""
    df = query.run(spark, sf_dir)
    got = rows_of([tuple(r) for r in df.collect()], df.columns)
    if query.sql is None:
        return [] if got else ["no rows"]
    result = con.execute(query.sql)
    names = [c[0] for c in result.description]
    types = [c[1] for c in result.description]
    want = rows_of(result.fetchall(), names)
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    spark_kinds = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    sql_kinds = {n: kind(t) for n, t in zip(names, types)}
    if spark_kinds != sql_kinds:
        problems.append(f"types {[(n, spark_kinds.get(n), k) for n, k in sql_kinds.items() if spark_kinds.get(n) != k]}")
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        problems.append(f"{len(got)} rows != {len(want)}; only spark {extra}; only sql {missing}")
    if not want:
        problems.append("no rows on either side")
    return problems


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from saleslayers.catalog.registry import QUERIES
    from saleslayers.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, query)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {'' if query.sql else '(no sql)'}", *problems, sep="\n     " if problems else "")
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
