"""Run registered queries and their SQL side by side and compare every value.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _sortable(row):
    return tuple((v is None, str(type(v)) if v is not None else "", v if v is not None else 0) for v in row)


def compare(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None if both agree, else what differs."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    mine = [tuple(_plain(r[c]) for c in cols) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    at = [names.index(c) for c in cols]
    theirs = [tuple(_plain(r[i]) for i in at) for r in cur.fetchall()]
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    pairs = list(zip(sorted(mine, key=_sortable), sorted(theirs, key=_sortable)))
    wrong = [(a, b) for a, b in pairs if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, e.g. {cols}: {wrong[0]}"
    return None if mine else "empty"


def main() -> None:
    import __spark_entry__ as entry
    from shopfloor.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_spark("oracle-check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in sqls:
                verdict = compare(spark, con, sf_dir, fn, sqls[name]) or "ok"
            else:
                verdict = f"rows only: {len(fn(spark, sf_dir).collect())}"
        except Exception as problem:  # noqa: BLE001
            verdict = f"FAILED {type(problem).__name__}: {str(problem)[:600]}"
        print(f"{name:28s} {time.time() - started:6.2f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main()
