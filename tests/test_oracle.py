"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest
from conftest import SF

from ledgerscope.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, sql, name):
    frame = registry.queries()[name](spark, SF)
    oracle = sql.sql(registry.oracle_sql()[name])
    assert rows(frame.columns, [tuple(r) for r in frame.collect()]) == rows(oracle.columns, oracle.fetchall())
