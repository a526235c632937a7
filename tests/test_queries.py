"""Every registered query against its DuckDB twin, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from trawl.plans.catalog import QUERIES as OWN

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "labels"]
# The library's own queries; those of the optional subpackage have their tests beside it.
QUERIES = {k: q for k, q in entry_mod.queries().items() if k in OWN}
ORACLE = {k: q for k, q in entry_mod.oracle_sql().items() if k in OWN}

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    return tuple(norm(x) for x in v) if isinstance(v, list) else v


def table(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["value"]
    assert df.count() > 0


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert types == {r[0]: r[1] for r in con.execute(f"DESCRIBE ({ORACLE[name]})").fetchall()}
    got = table(df.toPandas())
    want = table(con.execute(ORACLE[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_stream_equals_batch_flagship(spark):
    stream = sorted(r.value for r in QUERIES["stream_entity_lines"](spark, SF).collect())
    batch = sorted(r.value for r in entry_mod.entry(spark).collect())
    assert stream == batch and len(batch) > 0
