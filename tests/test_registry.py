"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from verdance.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(df):
    def one(x):
        if x is None or x is pd.NA or x != x:
            return None
        if isinstance(x, (bool, np.bool_)):
            return bool(x)
        if isinstance(x, (int, np.integer)):
            return int(x)
        if isinstance(x, (float, np.floating)):
            return float(x)
        return str(x)[:10] if hasattr(x, "year") else x

    df = df[sorted(df.columns)]
    return sorted((tuple(map(one, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    if name not in registry.oracle_sql():
        assert len(got)
        return
    want = duck.execute(registry.oracle_sql()[name]).df()
    a, b = plain(got), plain(want)
    assert sorted(got.columns) == sorted(want.columns) and len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == q or isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-12) for p, q in zip(x, y)), (x, y)
