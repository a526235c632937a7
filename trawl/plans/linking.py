"""L7 + S4: the whole job, pages or WARC records in, entity and relation lines out.

    pages/records -> page text (H) -> sentences, tokens (N1, N2)
      -> mentions by name lookup (N3, N4) -> links (C, L)
      -> POS (N5) -> relations (R) -> lines (S6, S4)

Stage outputs can be materialised (``stage_dir``) as parquet, so lineage
stays short.  A stage is always written anew: an earlier run's output may come
from other inputs or options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators import annotate as N
from trawl.operators.link import label_class_table, link_entities
from trawl.operators.pages import page_rows, pages_as_bodies
from trawl.operators.relations import linked_relations, sentence_relations
from trawl.plans import fixtures as fx
from trawl.sources.kb import KnowledgeGraph
from trawl.sources.lines import entity_lines, result_lines

# The NER label a gazetteer hit gets from its item's class
# (first label of the label map for that class).
CLASS_LABELS = [
    ("dbo:Person", "PERSON"),
    ("geo:SpatialThing", "GPE"),
    ("dbo:Language", "LANGUAGE"),
    ("dbo:Organisation", "ORG"),
    ("owl:Thing", "PRODUCT"),
    ("dbo:Event", "EVENT"),
    ("dbo:Work", "WORK_OF_ART"),
]


def gazetteer(spark: SparkSession, kb: KnowledgeGraph) -> DataFrame:
    """(name, label): English names with a label taken from the item's class."""
    cl = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(c).alias("class"), F.lit(lb).alias("label"))
                                                  for c, lb in CLASS_LABELS])))
    return kb.english_labels().join(kb.type, "item").join(F.broadcast(cl), "class").select("name", "label").distinct()


def materialise(df: DataFrame, stage_dir: str | None, name: str) -> DataFrame:
    """Write a stage to parquet and read it back (cuts lineage)."""
    if stage_dir is None:
        return df
    path = f"{stage_dir}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def annotate_pages(spark: SparkSession, rows: DataFrame, kb: KnowledgeGraph,
                   stage_dir: str) -> tuple[DataFrame, DataFrame]:
    """N1-N4 over page rows -> (sentences, mentions that do not overlap).

    Page tokens and mentions are written: a page must be parsed once only.
    """
    toks = materialise(N.page_tokens(rows, "key", "text"), stage_dir, "page_tokens")
    ments = N.longest_mentions(N.gazetteer_mentions(toks, gazetteer(spark, kb)))
    return N.sentence_rows(toks), materialise(ments, stage_dir, "mentions")


def link_pages(spark: SparkSession, rows: DataFrame, kb: KnowledgeGraph,
               lexicon: DataFrame | None = None, stage_dir: str | None = None,
               relations: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Entities (key, mention, link) and linked relations of page rows."""
    stage_dir = stage_dir or run_stage_dir(spark)
    sents, ments = annotate_pages(spark, rows, kb, stage_dir)
    ents, _ = link_entities(ments.select("key", "mention", "label"), kb, label_class_table(spark))
    ents = materialise(ents, stage_dir, "entities")
    if not relations:
        return ents, None
    # F10 first: only sentences with two or more entity spans are re-joined and tagged
    with_ents = N.sentence_entities(sents, ments, min_entities=2)
    rels = linked_relations(sentence_relations(N.tag_tokens(with_ents, lexicon)), ents)
    return ents, rels


def entity_lines_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: ENTITY lines for every page of ``pages`` (KB derived from ``documents``)."""
    from trawl.plans.catalog import pages

    rows = page_rows(pages_as_bodies(pages(spark, sf_dir)), p_mode="nested")
    kb = fx.stored_kb(spark, sf_dir)
    ents, _ = link_pages(spark, rows, kb, relations=False)
    return entity_lines(ents)


def run_stage_dir(spark: SparkSession) -> str:
    """A fresh folder for this run's stages under the shared checkpoint folder."""
    from trawl.session import stage_dir

    return stage_dir(spark)


def full_job(spark: SparkSession, sf_dir: str, stage_dir: str | None = None, ordered: bool = False,
             lexicon: DataFrame | None = None) -> DataFrame:
    """All output lines (entities, then relations per page when ``ordered``).

    Page text, sentences, mentions and entities each feed more than one
    consumer; they are written once as parquet under ``stage_dir`` (default:
    a new folder in the checkpoint folder) instead of being recomputed.
    """
    from trawl.plans.catalog import pages

    stage_dir = stage_dir or run_stage_dir(spark)
    rows = materialise(page_rows(pages_as_bodies(pages(spark, sf_dir)), p_mode="nested"), stage_dir, "page_text")
    kb = fx.stored_kb(spark, sf_dir)
    ents, rels = link_pages(spark, rows, kb, lexicon, stage_dir)
    return result_lines(ents, rels, ordered)
