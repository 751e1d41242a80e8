"""Compare a Spark query with its SQL on the same parquet tables."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v) -> str:
    if v is None or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, (list, tuple)):
        return repr([_cell(x) for x in v])
    return repr(v)


def _rows(names, data) -> list[tuple]:
    at = [names.index(c) for c in sorted(names)]
    return sorted(tuple(_cell(r[i]) for i in at) for r in data)


def compare(df, con, sql: str) -> tuple[bool, str]:
    """Same columns, same rows (as multisets), every value equal to the last bit."""
    cur = con.execute(sql)
    names, want = [c[0] for c in cur.description], cur.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    g, w = _rows(df.columns, got), _rows(names, want)
    if g != w:
        gs, ws = set(g), set(w)
        return False, f"rows {len(g)} vs {len(w)}; only spark {list(gs - ws)[:2]}; only sql {list(ws - gs)[:2]}"
    return True, f"{len(g)} rows"
