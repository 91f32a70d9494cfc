"""Every registered query with an SQL twin equals DuckDB on the small fixture (the driver's gate
runs the same comparison at sf0.01; ``tools/check_oracle.py`` does it locally)."""

import duckdb
import pytest

from conftest import SF_SMALL

from tools.check_oracle import TABLES, rows_key


def _names():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_sql(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    a, b = rows_key(df.columns, srows), rows_key(ocols, orows)
    assert len(a) == len(b)
    if a != b:
        # both sides round to 6 places; engines sum floats in different orders, so a value on a
        # rounding boundary may differ by one unit in the last place
        _close_rows(_coarse(df.columns, srows), _coarse(ocols, orows))


def _coarse(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(([r[i] for i in order] for r in rows), key=lambda r: [_sort_key(v) for v in r])


def _sort_key(v):
    if isinstance(v, float):
        return f"{round(v, 3):.3f}"
    return str(v)


def _close_rows(a, b):
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) or isinstance(y, float):
                assert x == pytest.approx(y, rel=1e-9, abs=1.5e-6)
            else:
                assert str(x) == str(y)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert [r[0] for r in rows] == ["Low (0-1)", "Medium (2-3)", "High (4+)"]
    assert sum(r["n"] for r in rows) == 150
