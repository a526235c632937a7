"""Ranking candidates and linking mentions, as aggregations and joins.

The original resolves each mention once (a per-process dict); here the
distinct mentions of the whole input are resolved in one set-oriented
pass and joined back (L5), optionally against a persistent link store so a
re-run only resolves mentions it has not seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.plan import hot_split_join
from trawl.functions.text import mention_key
from trawl.operators.candidates import KEYS, candidates
from trawl.session import stored
from trawl.sources.kb import KnowledgeGraph

# NER label -> knowledge-graph class.
LABEL_CLASSES = [
    ("PERSON", "dbo:Person"),
    ("GPE", "geo:SpatialThing"),
    ("LOC", "geo:SpatialThing"),
    ("FAC", "geo:SpatialThing"),
    ("LANGUAGE", "dbo:Language"),
    ("ORG", "dbo:Organisation"),
    ("PRODUCT", "owl:Thing"),
    ("EVENT", "dbo:Event"),
    ("DATE", "owl:Thing"),
    ("NORP", "owl:Thing"),
    ("WORK_OF_ART", "dbo:Work"),
]


def label_class_table(spark: SparkSession, pairs=None) -> DataFrame:
    """U4: the label map as a (label, class) DataFrame (11 rows by default)."""
    rows = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("class")) for a, b in (pairs or LABEL_CLASSES)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def with_class(mentions: DataFrame, label_classes: DataFrame) -> DataFrame:
    """keep mentions whose label is mapped, add its class.

    The map has a fixed, tiny size (one row per NER label), so it is
    broadcast: no shuffle of the mention side.
    """
    return mentions.join(F.broadcast(label_classes), "label")


# L1 ----------------------------------------------------------------------
def most_referred(cands: DataFrame, keys=None) -> DataFrame:
    """L1: per mention, max count, then min Levenshtein(rep, name), then min page.

    One aggregation with ``min_by`` on a struct key: no window, no sort.
    """
    keys = keys or KEYS
    order = F.struct(
        (-F.col("cnt")).alias("neg_cnt"), F.levenshtein("rep", "name").alias("lev"), F.col("page").alias("page")
    )
    return cands.groupBy(*keys).agg(F.min_by("page", order).alias("link"))


def most_popular(cands: DataFrame, backlinks: DataFrame, keys=None, namespace: int = 4) -> DataFrame:
    """L2: rank by backlinks from one namespace, ties by Levenshtein to the name.

    ``backlinks(title, from_page, ns)``: a backlink table in place of the
    live API; the title is the last URL segment of the candidate page.
    Candidates without any backlink row drop out (the API gave no answer);
    a mention whose candidates all drop out gets no row.  All backlinks
    count.
    """
    keys = keys or KEYS
    n = F.count(F.lit(1))
    counts = (
        backlinks.where(F.col("ns") == namespace)
        .groupBy("title").agg(n.alias("backlinks"))
    )
    titled = cands.withColumn("title", F.element_at(F.split("page", "/", -1), -1))
    ranked = titled.join(counts, "title")
    order = F.struct(
        (-F.col("backlinks")).alias("neg_bl"), F.levenshtein("rep", "name").alias("lev"), F.col("page").alias("page")
    )
    best = F.min_by(F.struct("name", "page", "item", "backlinks"), order)
    return ranked.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*")


def most_similar(cands: DataFrame, keys=None) -> DataFrame:
    """L3: the candidate whose name is nearest (Levenshtein) to the mention."""
    keys = keys or KEYS
    order = F.struct(F.levenshtein("rep", "name").alias("lev"), F.col("page").alias("page"), F.col("name").alias("nm"))
    best = F.min_by(F.struct("name", "page"), order)
    return cands.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*")


# L4/L5 -------------------------------------------------------------------
def distinct_mentions(mentions: DataFrame, label_classes: DataFrame) -> DataFrame:
    """F7 + L4: distinct (key, mention, label) with class and mention key."""
    return with_class(mentions.select("key", "mention", "label").dropDuplicates(["key", "mention", "label"]),
                      label_classes).withColumn("mention_key", mention_key(F.col("mention")))


def resolve_mentions(ments: DataFrame, kb: KnowledgeGraph, cache_scope: str = "class",
                     redirect: str = "zero_or_one", multiplicity: str = "bag",
                     cards: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """L5 resolution step: one answer per distinct mention -> (mention_key, class, rep, link).

    Keys of ``known`` are left out; they are compared after the mentions are
    grouped, so a frequent key is one row there.

    ``cache_scope="class"`` resolves each (mention_key, class) pair;
    ``"mention"`` resolves each mention_key once, with the smallest
    (label, mention) deciding class and raw text (the original's first-seen
    rule, made deterministic).  ``link`` is null for known misses.
    """
    rows = F.count(F.lit(1)).alias("n_rows")
    if cache_scope == "class":
        reps = ments.groupBy("mention_key", "class").agg(F.min("mention").alias("rep"), rows)
    elif cache_scope == "mention":
        first = F.min(F.struct("label", "mention", "class"))
        reps = ments.groupBy("mention_key").agg(first.alias("f"), rows).select(
            "mention_key", F.col("f.class").alias("class"), F.col("f.mention").alias("rep"), "n_rows")
    else:
        raise ValueError("cache_scope must be 'class' or 'mention'")
    if known is not None:
        scope = ["mention_key", "class"] if cache_scope == "class" else ["mention_key"]
        reps = reps.join(known.select(*scope), scope, "left_anti")
    best = most_referred(candidates(reps.drop("n_rows"), kb, redirect, multiplicity, cards))
    return reps.join(best, KEYS, "left").select(*KEYS, "link", "n_rows")


def join_links(ments: DataFrame, resolved: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Attach each mention's link; hot keys never go through a shuffle.

    ``resolved`` has one row per key and ``n_rows`` = mention rows of that
    key (counted in the same aggregation that picks the representative).
    One popular name may hold a third of all mentions: such keys are joined
    by broadcast (at most ``rows / hot_rows`` of them), see ``hot_split_join``.
    """
    res = resolved.select(*keys, "link", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    return hot_split_join(ments, res.drop("n_rows"), keys, hot_rows, counts=res.select(*keys, "n_rows"))


HOT_ROWS = 1_000_000  # mention rows per key above which a key is joined by broadcast


def link_entities(mentions: DataFrame, kb: KnowledgeGraph, label_classes: DataFrame,
                  cache_scope: str = "class", store: DataFrame | None = None,
                  redirect: str = "zero_or_one", multiplicity: str = "bag",
                  hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """L5 + L6: (entities(key, mention, link), resolved) for ``mentions(key, mention, label)``.

    With ``store`` (an earlier ``resolved`` output, nulls included) only the
    mentions missing from it are resolved (anti-join); the returned
    ``resolved`` is the store plus the new answers, to be appended.
    One mention text with two labels on a page keeps the link of the
    smallest label (Q16).
    """
    # read by the resolution and twice by the join of the answers
    ments = stored(distinct_mentions(mentions, label_classes), "mentions")
    scope_keys = ["mention_key", "class"] if cache_scope == "class" else ["mention_key"]
    if store is not None:
        fresh = resolve_mentions(ments, kb, cache_scope, redirect, multiplicity, known=store)
        resolved = store.select(*KEYS, "link", F.lit(None).cast("bigint").alias("n_rows")).unionByName(fresh)
        # row counts of this input, for keys answered by the store too
        counts = ments.groupBy(*scope_keys).agg(F.count(F.lit(1)).alias("n_rows"))
        for_join = resolved.drop("n_rows").join(counts, scope_keys)
    else:
        resolved = resolve_mentions(ments, kb, cache_scope, redirect, multiplicity)
        for_join = resolved
    if cache_scope == "mention":
        for_join = for_join.drop("class")
    joined = join_links(ments, for_join, scope_keys, hot_rows).where(F.col("link").isNotNull())
    entities = joined.groupBy("key", "mention").agg(F.min_by("link", "label").alias("link"))
    return entities, resolved
