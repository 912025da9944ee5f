"""Run queries and their SQL side by side: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as contract  # noqa: E402
from quillgrid.session import session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*(f"`{n}`" for n in names)).collect()), key=repr)


def rows_of_sql(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when equal, else what differs."""
    names, rows = rows_of_spark(contract.queries()[name](spark, sf_dir))
    sql_names, sql_rows = rows_of_sql(con, contract.oracle_sql()[name])
    if names != sql_names:
        return f"columns {names} / {sql_names}"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} rows / {len(sql_rows)}"
    if not rows:
        return "no rows"
    for ours, theirs in zip(rows, sql_rows):
        if ours != theirs:
            return f"{str(ours)[:300]} / {str(theirs)[:300]}"
    return None


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session(master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or contract.queries():
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # show all failures of a run
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:24} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
    print("differences:", bad)
