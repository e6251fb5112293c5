"""Run registered queries next to their SQL and report differences.

    python tools/compare.py [--sf 0.01] [name ...]
"""
from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gaugeworks.plans.catalog import ORACLES, QUERIES  # noqa: E402
from gaugeworks.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows) -> list[str]:
    """Rows as text with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join("null" if row[i] is None or row[i] != row[i] else
                           repr(row[i] + 0.0) if isinstance(row[i], float) else str(row[i])
                           for i in order) for row in rows)


def compare(spark, con, folder: str, name: str) -> tuple[str, int]:
    df = QUERIES[name](spark, folder)
    mine = canonical(df.columns, df.collect())
    if name not in ORACLES:
        return ("rows only" if mine else "EMPTY"), len(mine)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    theirs = canonical(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} vs {sorted(columns)}", len(mine)
    if mine != theirs:
        extra = [r for r in mine if r not in set(theirs)][:3]
        lack = [r for r in theirs if r not in set(mine)][:3]
        return f"DIFFERS {len(mine)} vs {len(theirs)}\n   mine   {extra}\n   theirs {lack}", len(mine)
    return ("ok" if mine else "ok, EMPTY"), len(mine)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            verdict, rows = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            verdict, rows = f"FAILED {type(error).__name__}: {str(error)[:600]}", -1
        bad += not (verdict.startswith("ok") or verdict == "rows only")
        print(f"{name:42s} {rows:7d} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("bad:", bad, "of", len(args.names or QUERIES))
    return bad


if __name__ == "__main__":
    sys.exit(main())
