"""Compare registered queries with their oracle SQL on one data directory.

Usage: python tests/check_oracle.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return ""
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    return str(v)


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(con, spark, sf_dir, fn, sql):
    """Empty when equal, else a short text."""
    df = fn(spark, sf_dir)
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want_cols, want = canonical(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    types = {n: t for n, t in df.dtypes}
    want_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP"}
    off = {n: (types[n], want_types[n]) for n in types if kinds.get(types[n], types[n]) != want_types[n]}
    note = f" types {off}" if off else ""
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}{note}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}{note}"
    return f"(equal){note}" if off else ""


def main():
    from fraudlens.session import build_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                out = differences(con, spark, sf_dir, fn, oracles[name])
            else:
                rows = fn(spark, sf_dir).collect()
                out = "" if rows else "no rows"
                if os.environ.get("SHOW"):
                    print(rows[:5])
        except Exception as err:  # noqa: BLE001
            out = f"{type(err).__name__}: {str(err)[:700]}"
        bad = bool(out) and not out.startswith("(equal)")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name:32s} {time.time() - start:6.2f}s {'' if name in oracles else '[rows] '}{out}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
