"""Run plans and their SQL statements on the same tables and compare them value by value."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value) -> str:
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(int(value)) if value == int(value) and abs(value) < 1e15 else repr(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def spark_rows(df):
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    return [df.columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in df.collect())


def sql_rows(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())


def differences(spark, con, folder: str, entry) -> str | None:
    names, rows = spark_rows(entry.build(spark, folder))
    if entry.sql is None:
        return None if rows else "no rows"
    expected_names, expected = sql_rows(con, entry.sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if rows != expected:
        have, want = set(rows), set(expected)
        return f"rows {len(rows)} vs {len(expected)}; only here {sorted(have - want)[:3]}; only there {sorted(want - have)[:3]}"
    return None


if __name__ == "__main__":
    from tidemark.plans import PLANS
    from tidemark.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    if os.environ.get("SPLIT_KEYS"):
        # treat every busy key as hot, to run the skew-safe plans on small tables
        from tidemark.skew import DEFAULT

        for field, value in {"min_rows": 30, "max_hot": 100_000}.items():
            object.__setattr__(DEFAULT, field, value)
    spark, con = local_session(), connect(folder)
    if os.environ.get("SPLIT_KEYS"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    bad = 0
    for name, entry in PLANS.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begun = time.time()
        try:
            problem = differences(spark, con, folder, entry)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - begun:.2f}s {problem or ''}", flush=True)
    print("bad", bad)
