"""The pipeline's rows against its stages run one after the other, and the SQL twins at the smallest size."""

import duckdb
import pytest

import corpus_pipeline
from trawl.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_pipeline_rows(lspark):
    docs = lspark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    low = {r.doc_id for r in lspark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(lspark, docs, SF)
        assert docs.columns == columns
        docs = lspark.createDataFrame(docs.collect(), docs.schema)
        now = {r.doc_id for r in docs.collect()}
        assert now <= ids
        if name == "line_dedup":
            assert now == ids
        ids = now
    assert not ids & low
    out = {r.doc_id: r.taken for r in corpus_pipeline.run(lspark, SF).collect()}
    assert set(out) == ids and sum(out.values()) > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twins(lspark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(ORACLE[name])
    df = QUERIES[name](lspark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    want = sorted(map(str, rel.select(*df.columns).fetchall()))
    assert sorted(str(tuple(r)) for r in df.collect()) == want
