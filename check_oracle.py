"""Run queries against their SQL checks: python check_oracle.py [sf_dir] [name-prefix ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from ledgerlark import session
from ledgerlark.registry import CHECKS, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def database(path: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet'")
    return db


def normal(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.12g}") + 0.0
    return v


def compare(spark, db, name: str, path: str) -> str:
    """Empty when columns and row multisets agree."""
    df = QUERIES[name](spark, path)
    columns = sorted(df.columns)
    ours = Counter(tuple(normal(v) for v in row) for row in df.select(columns).collect())
    if name not in CHECKS:
        return "" if ours else "no rows"
    listing = ", ".join(f'"{c}"' for c in columns)
    theirs = Counter(tuple(normal(v) for v in row)
                     for row in db.execute(f"SELECT {listing} FROM ({CHECKS[name]})").fetchall())
    if ours == theirs:
        return "" if ours else "no rows on both sides"
    missing, extra = list((theirs - ours).items()), list((ours - theirs).items())
    return (f"{sum(ours.values())} rows, expected {sum(theirs.values())}; {len(missing)} missing, {len(extra)} extra\n"
            f"   {columns}\n   missing {sorted(missing, key=str)[:2]}\n   extra   {sorted(extra, key=str)[:2]}")


def main(argv: list[str]) -> int:
    path = argv[0] if argv else "/root/testdata/sf0.01"
    from ledgerlark.registry import load_all
    load_all()
    spark = session.build("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = database(path), 0
    names = [n for n in QUERIES if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    for name in names:
        start = time.time()
        try:
            verdict = compare(spark, db, name, path)
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:700]}"
        kind = "sql " if name in CHECKS else "rows"
        if verdict:
            bad += 1
        print(f"{'FAIL' if verdict else 'ok  '} {kind} {time.time() - start:5.1f}s {name} {verdict}", flush=True)
    print(f"{len(names)} queries, {sum(n in CHECKS for n in names)} with SQL, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
