"""Runs registered queries beside their check SQL and compares the results as multisets.

``python -m tests.compare [--sf 0.01] [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    if hasattr(value, "quantize"):
        return float(value)
    return str(value)


def _rows(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def bad_plan(df) -> str:
    """Names an all-pairs join in the physical plan, if there is one."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return ", ".join(op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in plan)


def compare(spark, con, run, sql: str | None, sf_dir: str) -> str:
    """Empty text where both agree and there is something to agree on."""
    df = run(spark, sf_dir)
    problem = bad_plan(df)
    if problem:
        return problem
    columns, got = _rows(df.columns, df.collect())
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_columns, expected = _rows(names, cursor.fetchall())
    if columns != expected_columns:
        return f"columns {set(columns) ^ set(expected_columns)}"
    if got == expected:
        return "" if got else "no rows"
    extra, lost = got - expected, expected - got
    pairs = zip(sorted(extra, key=str)[:1], sorted(lost, key=str)[:1])
    diff = [[(c, a, b) for c, a, b in zip(columns, x, y) if a != b][:6] for x, y in pairs]
    return (f"rows {sum(got.values())}/{sum(expected.values())}, "
            f"{sum(extra.values())} extra, {sum(lost.values())} missing: {diff}")


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from basketlens.session import build_session

    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", cpus=8)
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv or queries:
        began = time.time()
        try:
            problem = compare(spark, con, queries[name], oracle.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql" if name in oracle else "rows"
        print(f"{'FAIL' if problem else 'ok'} {name} [{kind}] {time.time() - began:.1f}s {problem}", flush=True)
    print(f"{bad} failed")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
