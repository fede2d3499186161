"""Compare a query with its SQL on DuckDB: names, types, row count and values.

``python -m tests.oracle [--sf 0.01] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def _kind(dtype: pa.DataType) -> str:
    if pa.types.is_integer(dtype):
        return "int32" if dtype.bit_width <= 32 else "int64"
    if pa.types.is_floating(dtype):
        return "double" if dtype.bit_width == 64 else "float"
    if pa.types.is_string(dtype) or pa.types.is_large_string(dtype):
        return "string"
    if pa.types.is_timestamp(dtype):
        return "timestamp"
    return str(dtype)


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, dict)):
        return repr(value)
    return value


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = [[_norm(v) for v in table.column(n).to_pylist()] for n in names]
    rows = list(zip(*columns)) if columns else []
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark_table: pa.Table, oracle_table: pa.Table) -> list[str]:
    problems = []
    ours, theirs = sorted(spark_table.column_names), sorted(oracle_table.column_names)
    if ours != theirs:
        return [f"columns {ours} against {theirs}"]
    for n in ours:
        a, b = _kind(spark_table.schema.field(n).type), _kind(oracle_table.schema.field(n).type)
        if a != b:
            problems.append(f"type of {n}: {a} against {b}")
    if spark_table.num_rows != oracle_table.num_rows:
        return problems + [f"rows {spark_table.num_rows} against {oracle_table.num_rows}"]
    left, right = _rows(spark_table, ours), _rows(oracle_table, ours)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ in {ours}, first {different[0]}")
    return problems


def check(spark, con, query, path: str) -> list[str]:
    got = query.run(spark, path).toArrow()
    if got.num_rows == 0:
        return ["no rows"]
    if query.sql is None:
        return []
    want = con.sql(query.sql).to_arrow_table()
    return compare(got, want)


def main() -> int:
    from tidemill.plans import load_queries
    from tidemill.session import local_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    path = f"/root/testdata/sf{opts.sf}"
    spark = local_session("oracle")
    con = connect(path)
    bad = 0
    for name, q in load_queries().items():
        if opts.names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in opts.names):
            continue
        began = time.time()
        try:
            problems = check(spark, con, q, path)
        except Exception as error:  # report every query, then fail
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        state = "FAIL" if problems else ("ok" if q.sql else "ok (rows only)")
        print(f"{state:5} {name} {time.time() - began:.1f}s {' | '.join(problems)[:1200]}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
