"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

from conftest import ROOT


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_on_smoke_data(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    assert [f.name for f in df.schema.fields] == ["image_id", "y", "x", "gray"]
    assert df.count() == 1000


def test_every_oracle_has_a_query_and_names_are_unique(spark):
    mod = _entry_module()
    qs, oracles = mod.queries(), mod.oracle_sql()
    assert set(oracles) <= set(qs)
    # Every query of the library itself has an oracle.
    assert set(mod.QUERIES) <= set(oracles)
    for name, fn in qs.items():
        assert callable(fn), name
