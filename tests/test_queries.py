"""Every registered query with a SQL counterpart gives the rows that DuckDB gives."""

import duckdb
import pytest

from evidentia.plans import MODULES, catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    shown = lambda v: "null" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(shown(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    got = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in got.collect()]
    if name in ORACLES:
        want = duck.execute(ORACLES[name])
        names = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(names)
        assert rows_of(got.columns, rows) == rows_of(names, want.fetchall())
    else:
        assert rows


def test_entry_imports_without_llm():
    """Nothing outside evidentia/llm imports it."""
    import pathlib

    for path in pathlib.Path(catalog.__file__).parents[1].rglob("*.py"):
        if "llm" not in path.parts:
            assert "evidentia.llm" not in path.read_text(), path
