"""Compare registered queries with their SQL on a checking engine: ``python -m catlink.plans.check FOLDER [NAME…]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from catlink import session
from catlink.plans import queries, shapes


def _plain(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_plain(x) for x in v) + "]"
    return str(int(v)) if isinstance(v, int) else str(v)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in data)


def connect(folder: str):
    con = duckdb.connect()
    for t in shapes.BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder: str, name: str, query) -> str:
    start = time.time()
    df = query.build(queries.Ctx.of(spark, folder))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - start
    if query.oracle is None:
        return f"{name}: {len(got)} rows, no SQL ({spent:.1f}s)"
    start = time.time()
    cur = con.execute(queries.oracle(query.oracle))
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    tail = f"({spent:.1f}s, sql {time.time() - start:.1f}s)"
    if sorted(names) != sorted(df.columns):
        return f"{name}: COLUMNS {sorted(df.columns)} expected {sorted(names)} {tail}"
    if got == want:
        return f"{name}: ok, {len(got)} rows{' EMPTY' if not got else ''} {tail}"
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return f"{name}: DIFFERS {len(got)} rows, expected {len(want)} {tail}\n   got  {only_got}\n   want {only_want}"


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g")
        .config(session.FOLDER, "/tmp/catlink-checkpoint").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, query in queries.ALL.items():
        if names and name not in names:
            continue
        try:
            line = compare(spark, con, folder, name, query)
        except Exception as e:  # report and go on with the next query
            line = f"{name}: ERROR {type(e).__name__} {str(e)[:900]}"
        bad += ": ok" not in line and "no SQL" not in line
        print(line, flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
