"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else ("%.6f" % (x + 0.0)).replace("-0.000000", "0.000000")
    if isinstance(x, (list, tuple)):
        return tuple(_plain(i) for i in x)
    if isinstance(x, Decimal):
        return _plain(float(x))
    return str(x) if x is not None else None


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def _near(a, b, unit: float) -> bool:
    """Equal, or numbers one rounding unit apart: a value half-way may round either way."""
    if a == b:
        return True
    try:
        return abs(float(a) - float(b)) <= 1.01 * unit
    except (TypeError, ValueError):
        return False


def differences(df, sql: str, con, digits: int = 6) -> list[str]:
    """Human-readable differences; empty when all columns and rows agree."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want_rows = cur.fetchall()
    got_rows = [tuple(r) for r in df.collect()]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    got, want = _rows(df.columns, got_rows), _rows(names, want_rows)
    if len(got) != len(want):
        return [f"{len(got)} rows != {len(want)} rows", f"got {got[:2]}", f"want {want[:2]}"]
    unit = 10.0**-digits
    bad = [(g, w) for g, w in zip(got, want) if not all(_near(x, y, unit) for x, y in zip(g, w))]
    return [f"{len(bad)} of {len(got)} rows differ", *[f"got  {g}\nwant {w}" for g, w in bad[:3]]] if bad else []
