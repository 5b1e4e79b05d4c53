"""Every query of the catalog against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from codexmill.plans import catalog

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


def plain(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, D)
    columns = sorted(df.columns)
    got = plain(df.select(*[df[c] for c in columns]).collect())
    if name not in catalog.oracle_sql():
        assert got
        return
    sql = catalog.oracle_sql()[name]
    assert sorted(duck.sql(sql).columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert got == plain(duck.sql(f"select {quoted} from ({sql})").fetchall())


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
