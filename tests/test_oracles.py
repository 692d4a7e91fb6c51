"""Every registered query against its SQL counterpart, whole tables at the smallest scale."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from swipeflow.plans.oracles import ORACLES
from swipeflow.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(rows, names):
    def text(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(round(v, 9))
        return str(v)

    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    result = duck.execute(oracle_sql()[name])
    sql_names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(sql_names)
    assert canonical(df.collect(), df.columns) == canonical(result.fetchall(), sql_names)


def test_entry(spark):
    assert entry(spark).count() > 0
