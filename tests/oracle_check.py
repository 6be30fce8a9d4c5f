"""Run registered queries beside their oracle SQL: python tests/oracle_check.py [sf_dir] [key ...]"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(0.0 if v == 0 else v)
    return repr(v)


def as_rows(t: pa.Table) -> list:
    names = sorted(t.column_names)
    cols = [t.column(n).to_pylist() for n in names]
    return sorted([tuple(plain(v) for v in r) for r in zip(*cols)])


def kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_large_string(t) else str(t)


def compare(got: pa.Table, want: pa.Table) -> list[str]:
    bad = []
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"]
    for n in got.column_names:
        a, b = kind(got.schema.field(n).type), kind(want.schema.field(n).type)
        if a != b:
            bad.append(f"type {n}: {a} != {b}")
    a, b = as_rows(got), as_rows(want)
    if len(a) != len(b):
        bad.append(f"rows {len(a)} != {len(b)}")
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        bad.append(f"{len(diff)} rows differ, first {diff[0]}")
    return bad


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from saltmarsh.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    keys = [k for k in queries if not argv[1:] or any(k == a or (a.endswith("*") and k.startswith(a[:-1])) for a in argv[1:])]
    failed = 0
    for k in keys:
        t0 = time.time()
        try:
            got = queries[k](spark, sf_dir).toArrow()
        except Exception as e:  # report and go on
            failed += 1
            print(f"FAIL {k}: spark {str(e)[:600]}")
            continue
        t1 = time.time() - t0
        if k not in sql:
            print(f"rows {k}: {got.num_rows} rows {t1:.1f}s")
            continue
        try:
            want = con.execute(sql[k]).to_arrow_table()
        except Exception as e:
            failed += 1
            print(f"FAIL {k}: duckdb {str(e)[:600]}")
            continue
        bad = compare(got, want)
        failed += bool(bad)
        print(f"{'FAIL' if bad else 'ok  '} {k}: {got.num_rows} rows {t1:.1f}s {'; '.join(bad)[:900]}")
    print(f"{len(keys)} run, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
