"""Run queries in Spark and their SQL in DuckDB and compare rows as multisets.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starmart.bindings.catalog import QUERIES  # noqa: E402
from starmart.bindings.oracle import ORACLE  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
FAMILIES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    db = duckdb.connect()
    db.execute("set threads to 4")
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return db


def compare(spark, db, folder: str, name: str) -> list[str]:
    """Differences in columns, types or rows; empty if the query agrees with its SQL."""
    df = QUERIES[name](spark, folder)
    cursor = db.execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    columns = sorted(described)
    if sorted(df.columns) != columns:
        return [f"columns {sorted(df.columns)} against {columns}"]
    found = []
    for field in df.schema:
        kind = field.dataType.simpleString()
        if FAMILIES.get(kind, kind) != described[field.name]:
            found.append(f"{field.name}: {kind} against {described[field.name]}")
    order = [list(described).index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    missing, extra = theirs - ours, ours - theirs
    if missing or extra:
        found.append(f"{sum(missing.values())} rows missing, {sum(extra.values())} too many")
        found.append(f"missing {list(missing)[:2]} extra {list(extra)[:2]}")
    return found


def main() -> int:
    from starmart.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "starmart-check",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("CHECK_SHARED_DIR", "/tmp/starmart-check"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problems = compare(spark, db, folder, name)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for problem in problems:
            print("     ", problem)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
