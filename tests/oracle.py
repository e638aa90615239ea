"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v) if isinstance(v, (bool, str, bytes)) or v is None else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(frame, db, sql: str) -> tuple[int, str | None]:
    """Number of rows and, on a difference, what differs."""
    mine = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(sql)
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    n = sum(mine[1].values())
    if mine[0] != theirs[0]:
        return n, f"columns {mine[0]} vs {theirs[0]}"
    if mine[1] != theirs[1]:
        extra, lack = mine[1] - theirs[1], theirs[1] - mine[1]
        return n, (
            f"{n} rows vs {sum(theirs[1].values())}; only here {sum(extra.values())}: "
            f"{list(extra)[:3]}; only there {sum(lack.values())}: {list(lack)[:3]}"
        )
    return n, None
