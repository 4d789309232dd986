"""Compare registered queries with their SQL counterparts on DuckDB.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _canonical(value):
    return repr(value + 0.0) if isinstance(value, float) else repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canonical(row[i]) for i in order) for row in rows)


def compare(con, sql, df) -> str:
    """Empty when both sides agree, else what differs."""
    result = con.execute(sql)
    theirs = [c[0] for c in result.description]
    their_rows = result.fetchall()
    if sorted(theirs) != sorted(df.columns):
        return f"columns {sorted(set(theirs) ^ set(df.columns))}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    expected = _rows(theirs, their_rows)
    if len(ours) != len(expected):
        return f"rows {len(ours)} != {len(expected)}"
    differing = [(a, b) for a, b in zip(ours, expected, strict=True) if a != b]
    if not differing:
        return ""
    names = sorted(df.columns)
    a, b = differing[0]
    cells = [(n, x, y) for n, x, y in zip(names, a, b, strict=True) if x != y]
    return f"{len(differing)} of {len(ours)} rows, e.g. {cells[:4]}"


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, sql = session(), connect(folder), entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(con, sql[name], query(spark, folder))
            else:
                problem = f"(rows only) {query(spark, folder).count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem) and not problem.startswith("(rows")
        print(f"{name:26s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("differing:", failed)


if __name__ == "__main__":
    main()
