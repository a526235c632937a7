"""Candidate generation, the SPARQL graph pattern re-expressed as joins.

Input is one row per *distinct* mention to resolve: ``(mention_key, class,
rep)`` where ``rep`` is the raw mention text used for the forms.  Each
branch of the original union is an equi-join::

    C1  label hit            name = m2 (lang 'en')                -> item
    C2  redirect hit         label hit -> redirect? -> item
    C3  disambiguation page  page = R + m3 + '_(disambiguation)'  -> item
    C4  own-page disambig.   page = R + m3                        -> item
    C5  same four with (m0, m1) when m0 != m2
    C6  union all (bag)
    C7-C10 one join with the per-item cards (type, in-degree, page, names)
    C11 count = branch multiplicity x in-degree (eager aggregation)

No network, so C12 (endpoint failure) cannot happen: a mention without
rows is simply unlinked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.text import with_mention_forms
from trawl.sources.kb import RESOURCE, KnowledgeGraph

KEYS = ["mention_key", "class", "rep"]


def mention_form_rows(reps: DataFrame) -> DataFrame:
    """T7 + C5: one row per distinct (label_form, page_form) of each mention."""
    forms = F.array_distinct(
        F.array(
            F.struct(F.col("m2").alias("label_form"), F.col("m3").alias("page_form")),
            F.struct(F.col("m0").alias("label_form"), F.col("m1").alias("page_form")),
        )
    )
    return with_mention_forms(reps, "rep", KEYS).select(*KEYS, F.explode(forms).alias("f")).select(*KEYS, "f.label_form", "f.page_form")


def branch_rows(reps: DataFrame, kb: KnowledgeGraph, redirect: str = "zero_or_one") -> DataFrame:
    """The bag of (mention_key, class, rep, item, branch) rows.

    Each mention asks the graph's lookup index under up to six keys (label
    form, disambiguation page, own page; for m2/m3 and, if different,
    m0/m1); one equi-join answers all branches.
    """
    forms = mention_form_rows(reps)
    asks = forms.select(
        *KEYS,
        F.explode(F.array(
            F.struct(F.lit("label").alias("kind"), F.col("label_form").alias("key"),
                     F.lit(None).cast("string").alias("ask")),
            F.struct(F.lit("page").alias("kind"),
                     F.concat(F.lit(RESOURCE), "page_form", F.lit("_(disambiguation)")).alias("key"),
                     F.lit("disambig_page").alias("ask")),
            F.struct(F.lit("page").alias("kind"), F.concat(F.lit(RESOURCE), "page_form").alias("key"),
                     F.lit("disambig_self").alias("ask")),
        )).alias("a"),
    ).select(*KEYS, "a.kind", "a.key", "a.ask")
    hits = asks.join(kb.lookup(redirect), ["kind", "key"])
    return hits.select(*KEYS, "item", F.coalesce("branch", "ask").alias("branch"))


def candidates(reps: DataFrame, kb: KnowledgeGraph, redirect: str = "zero_or_one",
               multiplicity: str = "bag", cards: DataFrame | None = None) -> DataFrame:
    """C1-C11 -> (mention_key, class, rep, item, name, page, cnt).

    ``multiplicity="bag"`` keeps the original count semantics (an item reached
    k ways counts k x its in-links); ``"distinct"`` counts every item once.
    The branch bag is aggregated to one row per item *before* the join with
    the item cards, so the wide side never carries duplicates.
    """
    if multiplicity not in ("bag", "distinct"):
        raise ValueError("multiplicity must be 'bag' or 'distinct'")
    rows = branch_rows(reps, kb, redirect)
    mult = rows.groupBy(*KEYS, "item").agg(F.count(F.lit(1)).alias("mult"))
    if multiplicity == "distinct":
        mult = mult.withColumn("mult", F.lit(1).cast("bigint"))
    cards = cards if cards is not None else kb.item_cards()
    joined = mult.join(cards, ["item", "class"])
    return joined.select(
        *KEYS, "item", "name", "page", (F.col("mult") * F.col("in_degree")).cast("bigint").alias("cnt")
    )
