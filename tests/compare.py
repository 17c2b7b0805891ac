"""Compare registered queries with their DuckDB statements, row for row.

``python tests/compare.py [sf_dir] [name prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    """A float that is whole compares like the integer."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value)
    return str(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, sf_dir: str, run, sql: str) -> str:
    """Empty when columns and rows agree, else what differs."""
    df = run(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    theirs = rows_of(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if mine == theirs:
        return "" if mine else "no rows"
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}; "
        f"only Spark {only_mine.total()}: {list(only_mine)[:2]}; "
        f"only DuckDB {only_theirs.total()}: {list(only_theirs)[:2]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from lonja.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.perf_counter()
        try:
            if name in oracles:
                outcome = difference(spark, con, sf_dir, run, oracles[name])
            else:
                outcome = "" if run(spark, sf_dir).count() else "no rows"
        except Exception as error:  # a broken query must not hide the others
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(outcome)
        mark = "ok " if not outcome else "BAD"
        print(f"{mark} {time.perf_counter() - start:6.2f}s {name} {outcome}", flush=True)
    print(f"{bad} bad", flush=True)


if __name__ == "__main__":
    main()
