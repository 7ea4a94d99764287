"""Compare queries with their SQL, strictly: names, types, and every value.

    python tools/check_oracle.py SF_DIR [query ...]

CHECK_CONF holds session settings to try, as ``name=value,name=value``.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rideframe.catalog import ORACLES, QUERIES  # noqa: E402
from rideframe.session import build_session  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


TIMES: dict[str, float] = {}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return (1, "NaN")
    if value is None:
        return (0, "")
    if isinstance(value, datetime.datetime):
        return (2, value.isoformat())
    return (2, repr(value))


def compare(spark, con, sf_dir: str, name: str) -> list[str]:
    """Differences between a query and its SQL; an empty list if there are none."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    started = time.time()
    got = df.select(*[f"`{c}`" for c in columns]).collect()
    TIMES[name] = time.time() - started
    relation = con.sql(ORACLES[name])
    names = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    problems = []
    if sorted(names) != columns:
        return [f"columns {columns} vs {sorted(names)}"]
    for c, kind in df.dtypes:
        if DUCK_TYPES.get(kind, kind) != names[c]:
            problems.append(f"type of {c}: {kind} vs {names[c]}")
    wanted = relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    left = sorted(tuple(map(cell, row)) for row in got)
    right = sorted(tuple(map(cell, row)) for row in wanted)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        show = lambda rows: [dict(zip(columns, [v for _, v in row])) for row in rows]
        problems.append(f"{len(set(left) - set(right))} rows differ: {show(only_left)} vs {show(only_right)}")
    if not left:
        problems.append("no rows")
    return problems


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = build_session(
        master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    for setting in filter(None, os.environ.get("CHECK_CONF", "").split(",")):
        spark.conf.set(*setting.split("=", 1))
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        if name not in ORACLES:
            rows = QUERIES[name](spark, sf_dir).count()
            print(f"----  {name}: no SQL, {rows} rows, {time.time() - started:.1f} s", flush=True)
            continue
        try:
            problems = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '}  {name} {time.time() - started:.1f} s, collect {TIMES.get(name, 0):.1f} s", flush=True)
        for problem in problems:
            print(f"      {problem}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} queries differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
