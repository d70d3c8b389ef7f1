"""Every registered query against its SQL counterpart on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
OWN = {n for n in entry.queries() if not (entry.llm and (n in entry.llm.QUERIES or n == "pipeline"))}
QUERIES, SQL = ({n: x for n, x in every.items() if n in OWN} for every in (entry.queries(), entry.oracle_sql()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert rows
        return
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    order = sorted(df.columns)
    assert sorted(names) == order
    pick = lambda cols, rs: sorted((tuple(r[cols.index(c)] for c in order) for r in rs), key=repr)
    assert pick(df.columns, rows) == pick(names, cursor.fetchall())
