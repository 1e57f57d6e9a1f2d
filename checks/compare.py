"""Run every query on Spark and its SQL on DuckDB over the same folder and compare rows, names and types.

``python -m checks.compare [folder] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.registry import REGISTRY

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
         "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def differences(spark: SparkSession, con, name: str, folder: str) -> list[str]:
    """Empty when both engines agree."""
    df = REGISTRY[name](spark, folder)
    cols = sorted(df.columns)
    got = [tuple(_plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    rel = con.sql(ORACLE[name])
    out = []
    if sorted(rel.columns) != cols:
        return [f"columns {set(rel.columns) ^ set(cols)}"]
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema.fields:
        if TYPES.get(f.dataType.simpleString()) != want_types[f.name]:
            out.append(f"type {f.name}: {f.dataType.simpleString()} / {want_types[f.name]}")
    want = [tuple(_plain(v) for v in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()]
    if Counter(got) != Counter(want):
        a, b = Counter(got) - Counter(want), Counter(want) - Counter(got)
        out.append(f"rows {len(got)} / {len(want)}, {sum(a.values())} differ")
        key = lambda t: tuple(str(x) for x in t)
        for x, y in list(zip(sorted(a, key=key), sorted(b, key=key)))[:2]:
            out.append("   " + str({c: (p, q) for c, p, q in zip(cols, x, y) if p != q}) + f" in {dict(zip(cols, x))}")
    return out


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(REGISTRY)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in names:
        start = time.time()
        if name not in ORACLE:
            rows = len(REGISTRY[name](spark, folder).collect())
            print(f"rows only  {name}: {rows} rows {time.time() - start:.1f}s", flush=True)
            continue
        try:
            problems = differences(spark, con, name, folder)
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        print(f"{'ok  ' if not problems else 'FAIL'}  {name} {time.time() - start:.1f}s", *problems, sep="\n      " if problems else "", flush=True)
        bad += bool(problems)
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
