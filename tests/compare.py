"""Run registered queries beside their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "float:nan"
        return f"float:{value!r}"
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return f"int:{value}"
    if isinstance(value, datetime.datetime):
        return f"ts:{value.replace(tzinfo=None).isoformat()}"
    return f"{type(value).__name__}:{value!r}"


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, fn, sql):
    """None when equal, else a short account of the difference."""
    df = fn(spark, sf_dir)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = normal([d[0] for d in cur.description], cur.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}; {ours[1][:2]} / {theirs[1][:2]}"
    if ours[1] != theirs[1]:
        a, b = set(ours[1]), set(theirs[1])
        return f"values ({len(a - b)}): {ours[0]} {sorted(a - b)[:2]} / {sorted(b - a)[:2]}"
    if not ours[1]:
        return "both empty"
    return None


def main(argv):
    from pulsegrid.catalog import load_all
    from pulsegrid.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf_dir, argv = argv[0], argv[1:]
    queries, sql = load_all()
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                              "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, fn in queries.items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        t = time.time()
        try:
            if name in sql:
                why = compare(spark, con, sf_dir, name, fn, sql[name])
            else:
                n = len(fn(spark, sf_dir).collect())
                why = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            why = f"{type(e).__name__}: {str(e)[:400]}"
        kind = "sql " if name in sql else "rows"
        print(f"{'ok  ' if why is None else 'BAD '} {kind} {time.time() - t:6.2f}s {name} {why or ''}", flush=True)
        bad += why is not None
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
