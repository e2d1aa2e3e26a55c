"""Compare registered queries with their SQL in DuckDB: same rows, same column names, same values.

Usage: python tests/oracle_check.py SF_DIR [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def type_of(arrow_type):
    text = str(arrow_type)
    return text.replace("large_", "").replace("timestamp[us, tz=UTC]", "timestamp[us]").replace("timestamp[us, tz=Etc/UTC]", "timestamp[us]")


def rows_of(arrow_table):
    names = sorted(arrow_table.column_names)
    cols = [[cell(v) for v in arrow_table.column(c).to_pylist()] for c in names]
    return names, [type_of(arrow_table.schema.field(c).type) for c in names], sorted(zip(*cols), key=repr) if cols else []


def compare(spark, con, name, sf_dir, queries, oracles):
    """Return (ok, message, spark seconds)."""
    start = time.time()
    got = queries[name](spark, sf_dir).toArrow()
    spent = time.time() - start
    if name not in oracles:
        return True, f"rows-only: {got.num_rows} rows", spent
    want = con.execute(oracles[name]).to_arrow_table()
    gn, gt, gr = rows_of(got)
    wn, wt, wr = rows_of(want)
    if gn != wn:
        return False, f"columns {gn} != {wn}", spent
    if len(gr) != len(wr):
        return False, f"rows {len(gr)} != {len(wr)}", spent
    if gr != wr:
        bad = [(g, w) for g, w in zip(gr, wr) if g != w]
        return False, f"{len(bad)} of {len(gr)} rows differ, e.g. {bad[0]}", spent
    if gt != wt:
        return False, f"types {list(zip(gn, gt, wt))}", spent
    return True, f"{len(gr)} rows", spent


def main():
    from pyspark.sql import SparkSession

    from tallyspark.plans import ORACLES, QUERIES
    from tallyspark.session import build_session

    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:]) or ("",)
    spark, con = (SparkSession.builder.master("local[8]").getOrCreate() if os.environ.get("PLAIN_SESSION") else build_session()), duck(sf_dir)
    failed = []
    for name in QUERIES:
        if not name.startswith(prefixes):
            continue
        try:
            ok, message, spent = compare(spark, con, name, sf_dir, QUERIES, ORACLES)
        except Exception as error:  # report and go on with the next query
            ok, message, spent = False, f"{type(error).__name__}: {str(error)[:900]}", 0.0
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {spent:.2f}s {message}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
