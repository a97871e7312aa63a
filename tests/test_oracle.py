"""Every registered query against its oracle on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from portolan.plans.all import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", list(REGISTRY))
def test_matches_oracle(name, spark, duck, data):
    df = REGISTRY[name].run(spark, data)
    result = duck.execute(REGISTRY[name].sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == expected_types
    order = [names.index(c) for c in df.columns]
    expected = [tuple(r[i] for i in order) for r in result.fetchall()]
    assert _sorted([tuple(r) for r in df.collect()]) == _sorted(expected)


def test_entry_contract(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
