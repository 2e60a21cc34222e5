"""Compare a registered query with its SQL: columns by name, rows in any order."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def canonical(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, sql: str, con) -> str | None:
    """None when equal, else a short description."""
    relation = con.sql(sql)
    want_names, want = canonical(relation.columns, relation.fetchall())
    have_names, have = canonical(frame.columns, frame.collect())
    if want_names != have_names:
        return f"columns {have_names} != {want_names}"
    if want != have:
        only_have = sorted(set(have) - set(want))[:2]
        only_want = sorted(set(want) - set(have))[:2]
        return f"rows {len(have)} vs {len(want)}; only here {only_have}; only there {only_want}"
    return None
