import duckdb
import pytest

from alluvia.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([float(f"{r[i]:.9g}") if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    expected = con.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert plain([tuple(r) for r in got.collect()], got.columns) == plain(expected.fetchall(), names)
