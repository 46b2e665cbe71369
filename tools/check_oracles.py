"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tools/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import pathlib
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from millrace.plans import ORACLES, QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def compare(spark, db, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    if name not in ORACLES:
        return True, f"{len(got)} rows, no SQL"
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    order = [columns.index(c) for c in df.columns]
    want = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    have = Counter(got)
    if have == want:
        return True, f"{len(got)} rows"
    return False, (
        f"{len(got)} rows != {sum(want.values())}; only Spark {list((have - want).items())[:3]}; "
        f"only SQL {list((want - have).items())[:3]}"
    )


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark, db = local_session("8"), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            good, note = compare(spark, db, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:24} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    return bad > 0


if __name__ == "__main__":
    sys.exit(main())
