"""Compare every registered query with its SQL: ``python tests/oracle_check.py [scale or folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ambertill.registered import ORACLES, QUERIES
from ambertill.session import build_session, clear_scratch


def connection(folder: str):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None:
            return ("", "null")
        if isinstance(v, bool):
            return ("b", str(v))
        if isinstance(v, float):
            return ("f", "nan" if math.isnan(v) else repr(v))
        return (type(v).__name__, str(v))

    return sorted(tuple(cell(r[i]) for i in order) for r in rows), sorted(columns)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    chosen = args[1:] or list(QUERIES)
    folder = sf if "/" in sf else f"/root/testdata/sf{sf}"
    spark = build_session("oracles", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    failed = []
    for name in chosen:
        started = time.time()
        try:
            df = QUERIES[name](spark, folder)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - started
            if name not in ORACLES:
                print(f"rows {name}: {len(rows)} ({took:.2f}s)")
                continue
            rel = con.execute(ORACLES[name])
            columns = [d[0] for d in rel.description]
            types = {d[0]: str(d[1]) for d in rel.description}
            mine, mine_columns = canonical(rows, df.columns)
            theirs, their_columns = canonical(rel.fetchall(), columns)
            good = mine == theirs and mine_columns == their_columns
            print(f"{'ok  ' if good else 'DIFF'} {name}: {len(mine)} rows ({took:.2f}s)")
            if not good:
                failed.append(name)
                print("   columns", mine_columns, their_columns, dict(df.dtypes), types, len(theirs))
                only_mine = [r for r in mine if r not in set(theirs)][:3]
                only_theirs = [r for r in theirs if r not in set(mine)][:3]
                print("   spark ", only_mine, "\n   duckdb", only_theirs)
        except Exception:
            failed.append(name)
            print(f"FAIL {name}\n{traceback.format_exc()[-1800:]}")
    print("failed:", failed)
    clear_scratch(spark)
    return bool(failed)


if __name__ == "__main__":
    raise SystemExit(main())
