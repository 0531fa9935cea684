"""Exact, order-free comparison of a Spark result with its DuckDB cross-check."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def difference(frame, db, sql: str) -> str | None:
    """None when equal, otherwise a short description."""
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    found = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if found == expected:
        return None
    extra = list((found - expected).items())[:3]
    missing = list((expected - found).items())[:3]
    return (f"{sum(found.values())} rows vs {sum(expected.values())}; "
            f"columns {sorted(names)}\n  only Spark {extra}\n  only SQL {missing}")
