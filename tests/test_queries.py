"""Every registered query of the engine runs, and equals its SQL where it has one."""

import math

import duckdb
import pandas as pd
import pytest

from strata.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df):
    def value(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)) or v is pd.NA:
            return "NULL"
        return f"{v:.9g}" if isinstance(v, float) else str(v).replace(" 00:00:00", "")

    return sorted(tuple(map(value, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, oracle, name):
    got = registry.queries()[name](spark, SF).toPandas()
    if (sql := registry.oracle_sql().get(name)) is not None:
        assert rows(got) == rows(oracle.execute(sql).df())
    else:
        assert len(got)
