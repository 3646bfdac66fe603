"""t1: the driver contract of __spark_entry__.py."""

import importlib.util
import os


def _entry_module():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_contract(spark):
    m = _entry_module()
    df = m.entry(spark)
    cols = df.columns
    assert df.count() > 0
    assert m.entry(spark).columns == cols                      # stable schema
    q, sql = m.queries(), m.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 60
    assert set(q) - set(sql) <= set(m.LLM_QUERIES)             # the library's own queries all have an oracle
