"""Every catalogue query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

from conftest import SF01
from tessera.plans.catalog import QUERIES
from compare import compare, duckdb_views
from tessera.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF01)


# DuckDB result types and the Spark types they correspond to.
SPARK_TYPE = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    assert name in QUERIES, f"oracle without query: {name}"
    df = QUERIES[name](spark, SF01)
    rel = con.sql(ORACLES[name])
    want_types = {c: SPARK_TYPE.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert dict(df.dtypes) == want_types, f"{name}: schema differs"
    diff = compare(df.toPandas(), rel.df())
    assert diff is None, f"{name}: {diff}"


def test_every_query_runs_at_smoke_scale(spark):
    from conftest import SF001

    for name, fn in QUERIES.items():
        fn(spark, SF001).limit(1).collect()
