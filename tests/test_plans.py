"""Plan-shape checks: pruning, pushdown, no row-at-a-time Python, no cartesian joins."""

import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
QUERIES = entry_mod.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    p = plan(QUERIES["page_text"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p  # url never read
    p = plan(QUERIES["phrase_spans"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p  # every text, two columns


@pytest.mark.parametrize("name", ["page_entities", "link_entities", "linked_relations", "score_entity",
                                  "cand_count", "gazetteer_hits", "sentences", "process_text"])
def test_no_row_udfs_and_no_cartesian_joins(spark, name):
    p = plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_python_only_in_the_arrow_html_step(spark):
    p = plan(QUERIES["page_text_nested"](spark, SF))
    assert "MapInArrow" in p and "ArrowEvalPython" not in p
    # the chain writes its stages, so what is left of its plan reads the last one
    p = plan(QUERIES["page_entities"](spark, SF))
    assert "MapInArrow" not in p and "ArrowEvalPython" not in p
    assert "MapInArrow" not in plan(QUERIES["link_entities"](spark, SF))
