"""Run registered queries next to their SQL oracles and compare whole results.

    python tests/parity.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def canonical(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, v or "") for v in r))


def compare(spark, folder: str, name: str, query, sql: str | None) -> str:
    import duckdb

    start = time.time()
    df = query(spark, folder)
    left = rows_of(df.columns, df.collect())
    took = time.time() - start
    if sql is None:
        return f"rows-only rows={len(left)} spark={took:.1f}s"
    start = time.time()
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = db.execute(sql)
    columns = [c[0] for c in found.description]
    right = rows_of(columns, found.fetchall())
    oracle = time.time() - start
    if sorted(columns) != sorted(df.columns):
        return f"MISMATCH columns {sorted(df.columns)} / {sorted(columns)}"
    if left != right:
        extra = [r for r in left if r not in set(right)][:3]
        missing = [r for r in right if r not in set(left)][:3]
        return f"MISMATCH rows {len(left)}/{len(right)}\n  spark {extra}\n  sql   {missing}"
    return f"ok rows={len(left)} spark={took:.1f}s sql={oracle:.1f}s"


def main() -> None:
    import __spark_entry__ as entry
    from docweave.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        try:
            result = compare(spark, folder, name, entry.queries()[name], entry.oracle_sql().get(name))
        except Exception as error:  # noqa: BLE001 - a report, not a handler
            result = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name}: {result}", flush=True)


if __name__ == "__main__":
    main()
