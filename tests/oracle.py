"""Compare registered queries with their SQL twins on one folder.

    python tests/oracle.py /root/testdata/sf0.01 [key-prefix ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("larkspur-tests")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    return value


def kind(value):
    return {int: "int", float: "float", str: "str", bool: "bool"}.get(type(value), type(value).__name__)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return normalise(df.columns, [tuple(r) for r in df.collect()])


def duck(folder):
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return normalise(columns, cursor.fetchall())


def difference(got, want):
    """None when equal, else a short description."""
    (gc, gr), (wc, wr) = got, want
    if gc != wc:
        return f"columns {gc} != {wc}"
    if len(gr) != len(wr):
        return f"rows {len(gr)} != {len(wr)}; first {gr[:2]} | {wr[:2]}"
    for g, w in zip(gr, wr):
        if g != w:
            return f"row {g} != {w}"
        for a, b in zip(g, w):
            if kind(a) != kind(b):
                return f"type {kind(a)} != {kind(b)} in {g} / {w}"
    return None


def main(folder, prefixes):
    import __spark_entry__ as entry

    spark = session()
    con = duck(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            got = spark_rows(run(spark, folder))
            took = time.time() - start
            if name not in oracle:
                print(f"rows {name} {len(got[1])} {took:.1f}s", got[1][:1] if "-v" in sys.argv else "")
                continue
            start = time.time()
            why = difference(got, duck_rows(con, oracle[name]))
            duck_took = time.time() - start
        except Exception as error:  # noqa: BLE001 - report and go on
            why = f"{type(error).__name__}: {str(error)[:700]}"
            took = time.time() - start
            duck_took = 0
        if why:
            bad += 1
            print(f"BAD  {name} {took:.1f}s: {why[:900]}", flush=True)
        else:
            slow = "SLOW " if took > 3 else ""
            print(f"ok   {slow}{name} {len(got[1])} rows {took:.1f}s duck {duck_took:.1f}s", flush=True)
    print("bad", bad)


if __name__ == "__main__":
    main(sys.argv[1], [a for a in sys.argv[2:] if not a.startswith("-")])
