"""Run registered queries against their SQL twins.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows):
    return sorted(repr(tuple(row)) for row in rows)


def compare(spark, con, sf_dir, query, sql):
    """Empty text if both give the same names and rows, else what differs."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    told = con.sql(sql)
    if sorted(told.columns) != names:
        return f"columns {names} and {sorted(told.columns)}", 0
    expected = told.select(*[f'"{n}"' for n in names]).fetchall()
    got, want = normal(rows), normal(expected)
    if got == want:
        return "", len(got)
    only_got, only_want = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
    return f"{len(got)} and {len(want)} rows; ours {only_got}; SQL {only_want}", len(got)


def main():
    import __spark_entry__ as entry
    from pricegrid import get_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args else "/root/testdata/sf0.01"
    spark = get_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            problem, count = compare(spark, con, sf_dir, query, twins[name])
        except Exception as error:  # report and go on with the next query
            problem, count = f"{type(error).__name__}: {str(error)[:900]}", 0
        bad += bool(problem)
        print(f"{name:26} {time.time() - start:6.2f}s {count:8} {problem[:1200] or 'ok'}", flush=True)
    print("all equal" if not bad else f"{bad} differ")


if __name__ == "__main__":
    main()
