"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [-d folder] [name ...]``."""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")


def connect(folder: str = FOLDER):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    """Comparable form of a cell; types stay apart."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(table) -> tuple[list[str], dict[str, str], list[tuple]]:
    names = sorted(table.column_names)
    kinds = {n: str(table.schema.field(n).type).replace("large_", "") for n in names}
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(plain(v) for v in row) for row in zip(*columns)]
    rows.sort(key=lambda r: tuple((v is None, str(type(v)), v if not isinstance(v, tuple) else str(v)) for v in r))
    return names, kinds, rows


def compare(got, want) -> str | None:
    """``None`` when both tables hold the same rows, else what differs."""
    n1, k1, r1 = rows_of(got)
    n2, k2, r2 = rows_of(want)
    if n1 != n2:
        return f"columns {n1} and {n2}"
    if k1 != k2:
        return "types " + ", ".join(f"{n}: {k1[n]} / {k2[n]}" for n in n1 if k1[n] != k2[n])
    if len(r1) != len(r2):
        return f"rows {len(r1)} and {len(r2)}"
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    return f"{len(bad)} of {len(r1)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main() -> int:
    import __spark_entry__ as entry
    from mnemospark.session import local_session
    parser = argparse.ArgumentParser()
    parser.add_argument("-d", default=FOLDER)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.d)
    queries, sql = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args.names or any(n.startswith(a) for a in args.names)]
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = queries[name](spark, args.d).toArrow()
            mid = time.time()
            if name in sql:
                problem = compare(got, con.sql(sql[name]).to_arrow_table())
            else:
                problem = None if got.num_rows else "no rows"
        except Exception as exc:  # noqa: BLE001
            mid, problem = time.time(), f"{type(exc).__name__}: {str(exc)[:1500]}"
        failed += problem is not None
        rows = got.num_rows if problem is None else "-"
        print(f"{'FAIL' if problem else 'ok' if name in sql else 'rows'} {name} {rows} rows "
              f"spark {mid - start:.1f}s sql {time.time() - mid:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} fine")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
