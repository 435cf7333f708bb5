"""Run queries on Spark and their SQL twins on DuckDB and compare every value.

    python -m parity.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from tidemark.session import local_session

from .oracle import oracle_sql
from .queries import queries

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs between the two engines for one query; empty when they agree."""
    df = queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)
    cur = con.execute(oracle_sql()[name])
    their_cols = [d[0] for d in cur.description]
    if sorted(their_cols) != cols:
        return [f"columns {cols} vs {sorted(their_cols)}"]
    at = [their_cols.index(c) for c in cols]
    theirs = sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=_key)
    out = []
    if len(ours) != len(theirs):
        out.append(f"{len(ours)} rows vs {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=False) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ in {cols}, first {wrong[0]}")
    kinds = [(c, {type(r[i]) for r in ours} - {type(None)}, {type(r[i]) for r in theirs} - {type(None)})
             for i, c in enumerate(cols)]
    out += [f"type of {c}: {a} vs {b}" for c, a, b in kinds if a != b]
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else DEFAULT_DIR
    names = argv[1:] or list(queries())
    spark, con = local_session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.perf_counter()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as e:  # keep going: the point is the list
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:28s} {time.perf_counter() - start:6.2f}s "
              f"{' | '.join(found)}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
