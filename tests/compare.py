"""Run catalog queries and their SQL side by side: `python tests/compare.py SF_DIR [query ...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(out, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def differences(spark_df, db, sql: str) -> tuple[int, list[str]]:
    """Row count and what differs; values must be equal, not close."""
    names, got = rows_of(spark_df.columns, spark_df.collect())
    cursor = db.execute(sql)
    wanted_names, wanted = rows_of([column[0] for column in cursor.description], cursor.fetchall())
    problems = []
    if names != wanted_names:
        return len(got), [f"columns {names} != {wanted_names}"]
    if len(got) != len(wanted):
        problems.append(f"{len(got)} rows, not {len(wanted)}")
    unequal = [(a, b) for a, b in zip(got, wanted) if a != b]
    if unequal:
        problems.append(f"{len(unequal)} rows differ, such as {dict(zip(names, unequal[0][0]))} and {dict(zip(names, unequal[0][1]))}")
    return len(got), problems


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from ratestrata.session import build_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    db, sql = connect(sf_dir), oracle_sql()
    for name, run in queries().items():
        if (chosen and name not in chosen) or name not in sql:
            continue
        start = time.time()
        try:
            count, problems = differences(run(spark, sf_dir), db, sql[name])
        except Exception as error:
            count, problems = -1, [f"{type(error).__name__}: {str(error)[:900]}"]
        print(f"{'FAIL' if problems else 'ok  '} {name:28} {count:8} rows {time.time() - start:6.2f}s", *problems, flush=True)


if __name__ == "__main__":
    main()
