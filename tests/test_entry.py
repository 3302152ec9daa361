"""The driver's contract, and every oracle against its query on the smallest data for a few cheap ones."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_contract(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["ag1_price_ladder", "flt3_clean_offers", "wn1_rank_attributes", "shp1_walk_points", "jn6_name_match"])
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cols = sorted(entry.queries()[name](spark, SF).columns)
    ours = [tuple(str(r[c]) for c in cols) for r in entry.queries()[name](spark, SF).collect()]
    got = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in got.description]
    theirs = [tuple(str(dict(zip(names, r, strict=True))[c]) for c in cols) for r in got.fetchall()]
    assert sorted(ours) == sorted(theirs)
