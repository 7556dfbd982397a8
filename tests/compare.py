"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str, tables: list[str] = TABLES) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in tables:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(rows: list[tuple], order: list[int]) -> list[tuple]:
    picked = [tuple(row[i] for i in order) for row in rows]
    for row in picked:
        assert not any(isinstance(v, float) and math.copysign(1, v) < 0 and v == 0 for v in row)
    return sorted(picked, key=_key)


def compare(df, con, sql: str) -> int:
    """Assert equal column names, types and rows; return the row count."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    theirs = _plain(answer.fetchall(), sorted(range(len(names)), key=names.__getitem__))
    ours = _plain(
        [tuple(r) for r in df.collect()],
        sorted(range(len(df.columns)), key=df.columns.__getitem__),
    )
    assert sorted(df.columns) == sorted(names)
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    different = [(a, b) for a, b in zip(ours, theirs) if a != b or list(map(type, a)) != list(map(type, b))]
    assert not different, (len(different), different[:3])
    return len(ours)
