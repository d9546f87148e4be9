"""Every registered query of the analytics side against its SQL, over the smallest tables."""

import duckdb
import pytest

from marisight.plans import file_queries, listing_queries, record_queries, retrieval_queries, table_queries, walk_queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = {**retrieval_queries.QUERIES, **table_queries.QUERIES, **record_queries.QUERIES, **listing_queries.QUERIES, **walk_queries.QUERIES, **file_queries.QUERIES}
ORACLE = {**retrieval_queries.ORACLE_SQL, **table_queries.ORACLE_SQL, **record_queries.ORACLE_SQL, **listing_queries.ORACLE_SQL, **walk_queries.ORACLE_SQL, **file_queries.ORACLE_SQL}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert in_order(got) == in_order(want) and got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
