"""The knowledge graph as six tables, instead of a remote endpoint.

``KnowledgeGraph`` holds the tables the candidate joins read::

    label(item, name, lang)      rdfs:label
    redirect(src, dst)           dbo:wikiPageRedirects
    disambig(page, item)         dbo:wikiPageDisambiguates
    type(item, class)            rdf:type (class compacted to a prefixed name)
    link(source, target)         dbo:wikiPageWikiLink
    topic(item, page)            foaf:isPrimaryTopicOf

``link`` is by far the largest table and is only ever used through its
per-target count; ``item_cards()`` pre-joins everything keyed by item once
(type, in-degree, page, English names), so candidate generation needs one
join per mention set instead of four.  ``save`` writes every table
hash-partitioned and sorted by its join key, so a reader at scale gets
co-located, pre-sorted files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Predicate URIs read from N-Triples dumps.
P_LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
P_REDIRECT = "http://dbpedia.org/ontology/wikiPageRedirects"
P_DISAMBIG = "http://dbpedia.org/ontology/wikiPageDisambiguates"
P_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
P_LINK = "http://dbpedia.org/ontology/wikiPageWikiLink"
P_TOPIC = "http://xmlns.com/foaf/0.1/isPrimaryTopicOf"

# Prefixes used to write classes as the label map names them.
CLASS_PREFIXES = [
    ("dbo:", "http://dbpedia.org/ontology/"),
    ("geo:", "http://www.w3.org/2003/01/geo/wgs84_pos#"),
    ("owl:", "http://www.w3.org/2002/07/owl#"),
]

RESOURCE = "http://dbpedia.org/resource/"

_JOIN_KEYS = {
    "label": "name",
    "redirect": "src",
    "disambig": "page",
    "type": "item",
    "link": "target",
    "topic": "item",
}


TABLES = ["label", "redirect", "disambig", "type", "link", "topic"]


@dataclass
class KnowledgeGraph:
    label: DataFrame
    redirect: DataFrame
    disambig: DataFrame
    type: DataFrame
    link: DataFrame
    topic: DataFrame
    cards: DataFrame | None = None  # stored item_cards(), when loaded from disk
    lookup_index: DataFrame | None = None  # stored lookup(), when loaded from disk

    def english_labels(self) -> DataFrame:
        """C1/C2 side: names with language tag exactly ``en``."""
        return self.label.where(F.col("lang") == "en").select("item", "name")

    def in_degree(self) -> DataFrame:
        """C8/C11 eager aggregation: in-links per target (triples are a set)."""
        return self.link.groupBy(F.col("target").alias("item")).agg(F.count(F.lit(1)).alias("in_degree"))

    def item_cards(self) -> DataFrame:
        """C7-C10 pre-joined per item: (item, class, in_degree, page, name).

        ``langMatches(lang, "en")``: ``en`` or ``en-*``, case-insensitive.
        Items without in-links, page or English name vanish, as in the
        original graph pattern.
        """
        if self.cards is not None:
            return self.cards
        lang = F.lower(F.col("lang"))
        names = self.label.where((lang == "en") | lang.startswith("en-")).select("item", "name")
        return (
            self.type.select("item", "class").distinct()
            .join(self.in_degree(), "item")
            .join(self.topic.select("item", "page"), "item")
            .join(names, "item")
        )

    def lookup(self, redirect: str = "zero_or_one") -> DataFrame:
        """C1-C4 as one index: (kind, key, item, branch).

        ``kind='label'``: an English name leads to its item (C1), to the
        item again as the zero-step of the redirect path (C2, SPARQL ``p?``)
        and to every redirect target of it (C2); ``kind='page'``: a
        disambiguation page leads to the items it lists (C3/C4).  Built once
        per graph, so candidate generation is a single equi-join.
        """
        if redirect not in ("zero_or_one", "one"):
            raise ValueError("redirect must be 'zero_or_one' or 'one'")
        if self.lookup_index is not None and redirect == "zero_or_one":
            return self.lookup_index
        labels = self.english_labels()
        rows = labels.select(F.lit("label").alias("kind"), F.col("name").alias("key"), "item",
                             F.lit("label").alias("branch"))
        hop = labels.join(self.redirect, labels.item == self.redirect.src).select(
            F.lit("label").alias("kind"), F.col("name").alias("key"), F.col("dst").alias("item"),
            F.lit("redirect").alias("branch"), F.col("item").alias("_temp"))
        if redirect == "zero_or_one":
            rows = rows.unionByName(labels.select(F.lit("label").alias("kind"), F.col("name").alias("key"), "item",
                                                  F.lit("redirect").alias("branch")))
            hop = hop.where(F.col("item") != F.col("_temp"))
        rows = rows.unionByName(hop.drop("_temp"))
        pages = self.disambig.select(F.lit("page").alias("kind"), F.col("page").alias("key"), "item",
                                     F.lit(None).cast("string").alias("branch"))
        return rows.unionByName(pages)

    def salted_links(self, rows_per_part: int) -> DataFrame:
        """``link`` with ``salt``: an item with many in-links is dealt over pieces of an eighth of a part.

        Small pieces even out where several fall into one part.
        """
        piece = max(1, rows_per_part // 8)
        hot = self.in_degree().where(F.col("in_degree") > piece).select(
            F.col("item").alias("target"), F.ceil(F.col("in_degree") / piece).alias("salts"))
        salts = F.coalesce("salts", F.lit(1))  # at most links / piece items are hot
        return self.link.join(F.broadcast(hot), "target", "left").select(
            "source", "target", F.pmod(F.xxhash64("source"), salts).cast("int").alias("salt"))

    def save(self, path: str, partitions: int | None = None, rows_per_part: int = 2_000_000) -> None:
        """Write each table partitioned and sorted by its join key, plus the item cards.

        The cards are the eager aggregation of the link table joined to the
        other per-item tables, computed once here instead of per query.  Without ``partitions``
        every table gets parts of about ``rows_per_part`` rows; in the link table
        an item with more in-links than that is dealt over several parts.
        """
        for name in TABLES:
            key = _JOIN_KEYS[name]
            df: DataFrame = getattr(self, name)
            n = partitions or max(8, -(-df.count() // rows_per_part))
            if name == "link":
                dealt = self.salted_links(rows_per_part).repartition(n, key, "salt").sortWithinPartitions(key).drop("salt")
            else:
                dealt = df.repartition(n, key).sortWithinPartitions(key)
            dealt.write.mode("overwrite").parquet(f"{path}/kb_{name}")
        spark = self.label.sparkSession
        # what is derived reads the written tables, not what they were made from
        done = KnowledgeGraph(**{name: spark.read.parquet(f"{path}/kb_{name}") for name in TABLES},
                              cards=self.cards, lookup_index=self.lookup_index)
        partitions = partitions or max(8, -(-done.label.count() // rows_per_part))
        (done.lookup().repartition(partitions, "kind", "key").sortWithinPartitions("kind", "key")
         .write.mode("overwrite").parquet(f"{path}/kb_lookup"))
        (done.item_cards().repartition(partitions, "item").sortWithinPartitions("item")
         .write.mode("overwrite").parquet(f"{path}/kb_item_cards"))

    def save_tables(self, path: str, prefix: str = "kb", buckets: int = 512) -> None:
        """Write every table as a bucketed catalog table (external, under ``path``).

        Bucketed by its join key and sorted within buckets: a later join with
        the graph shuffles only the mention side to the bucket layout, never
        the graph side.  Needs a catalog shared by the cluster.
        """
        tables = {name: (getattr(self, name), [_JOIN_KEYS[name]]) for name in TABLES}
        tables["lookup"] = (self.lookup(), ["kind", "key"])
        tables["item_cards"] = (self.item_cards(), ["item", "class"])
        for name, (df, keys) in tables.items():
            (df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
             .option("path", f"{path}/kb_{name}").saveAsTable(f"{prefix}_{name}"))

    @staticmethod
    def load_tables(spark: SparkSession, prefix: str = "kb") -> "KnowledgeGraph":
        tables = {name: spark.table(f"{prefix}_{name}") for name in TABLES}
        return KnowledgeGraph(**tables, cards=spark.table(f"{prefix}_item_cards"),
                              lookup_index=spark.table(f"{prefix}_lookup"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "KnowledgeGraph":
        tables = {name: spark.read.parquet(f"{path}/kb_{name}") for name in TABLES}
        return KnowledgeGraph(**tables, cards=spark.read.parquet(f"{path}/kb_item_cards"),
                              lookup_index=spark.read.parquet(f"{path}/kb_lookup"))


def compact_class(col) -> F.Column:
    out = col
    for short, full in CLASS_PREFIXES:
        out = F.when(col.startswith(full), F.concat(F.lit(short), F.substring(col, len(full) + 1, 1 << 20))).otherwise(out)
    return out


# N-Triples: <s> <p> <o> .   or   <s> <p> "literal"@lang .   , with an optional comment; nodes may be blank (_:x)
_NT = (r'^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(?:(<[^>]*>|_:\S+?)|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<[^>]*>)?)'
       r'\s*\.\s*(?:#.*)?$')


# One-letter string escapes.
_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", '"': '"', "'": "'", "\\": "\\"}
_PIECE = r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\[^uU]|\\|[^\\]+"


def unescape(text: Column) -> Column:
    """N-Triples escapes decoded, left to right; an unknown escape stays as it is."""
    def piece(p):
        kind = F.substring(p, 2, 1)
        out = F.when(F.substring(p, 1, 1) != "\\", p)
        out = out.when((kind == "u") & (F.length(p) > 2), F.decode(F.unhex(F.replace(p, F.lit("\\u"), F.lit(""))), "UTF-16BE"))
        out = out.when((kind == "U") & (F.length(p) > 2), F.decode(F.unhex(F.substring(p, 3, 8)), "UTF-32"))
        for letter, char in _ESCAPES.items():
            out = out.when(kind == letter, F.lit(char))
        return out.otherwise(p)

    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(
        F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), piece), "")).otherwise(text)


def parse_ntriples(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """N-Triples lines -> (s, p, o, lang); ``o`` is an IRI or an unescaped literal."""
    v = F.col(value_col)
    lit = F.regexp_extract(v, _NT, 4)

    def node(group):
        return F.regexp_replace(F.regexp_extract(v, _NT, group), "^<|>$", "")

    iri = node(3)
    return lines.where(v.rlike(_NT)).select(
        unescape(node(1)).alias("s"),
        F.regexp_extract(v, _NT, 2).alias("p"),
        unescape(F.when(iri != "", iri).otherwise(lit)).alias("o"),
        F.regexp_extract(v, _NT, 5).alias("lang"),
    )


def rejected_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The lines ``parse_ntriples`` does not take, but for blank lines and comments."""
    v = F.col(value_col)
    return lines.where(~v.rlike(_NT) & ~v.rlike(r"^\s*(?:#|\z)"))


def from_triples(triples: DataFrame) -> KnowledgeGraph:
    """Split (s, p, o, lang) by predicate into the six tables (as sets)."""
    t = triples

    def pick(pred):
        return t.where(F.col("p") == pred)

    return KnowledgeGraph(
        label=pick(P_LABEL).select(F.col("s").alias("item"), F.col("o").alias("name"), "lang").dropDuplicates(),
        redirect=pick(P_REDIRECT).select(F.col("s").alias("src"), F.col("o").alias("dst")).dropDuplicates(),
        disambig=pick(P_DISAMBIG).select(F.col("s").alias("page"), F.col("o").alias("item")).dropDuplicates(),
        type=pick(P_TYPE).select(F.col("s").alias("item"), compact_class(F.col("o")).alias("class")).dropDuplicates(),
        link=pick(P_LINK).select(F.col("s").alias("source"), F.col("o").alias("target")).dropDuplicates(),
        topic=pick(P_TOPIC).select(F.col("s").alias("item"), F.col("o").alias("page")).dropDuplicates(),
    )


def read_ntriples(spark: SparkSession, path: str, stage: str | None = None) -> KnowledgeGraph:
    """N-Triples dump files (plain or compressed) -> KnowledgeGraph.

    With ``stage``, a folder for this load, the dump is parsed once into one
    subfolder per predicate and each table reads only its own.
    """
    triples = parse_ntriples(spark.read.text(path))
    if stage is None:
        return from_triples(triples)
    wanted = triples.where(F.col("p").isin(P_LABEL, P_REDIRECT, P_DISAMBIG, P_TYPE, P_LINK, P_TOPIC))
    wanted.write.mode("overwrite").partitionBy("p").parquet(stage)
    return from_triples(spark.read.schema("s string, o string, lang string, p string").parquet(stage))


def to_ntriples(kb: KnowledgeGraph) -> DataFrame:
    """The inverse of ``read_ntriples`` (one ``value`` line per triple)."""
    def iri(c):
        return F.concat(F.lit("<"), c, F.lit(">"))

    def lit(c, lang):
        esc = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', r'\\"')
        return F.concat(F.lit('"'), esc, F.lit('"@'), lang)

    def expand(c):
        out = c
        for short, full in CLASS_PREFIXES:
            out = F.when(c.startswith(short), F.concat(F.lit(full), F.substring(c, len(short) + 1, 1 << 20))).otherwise(out)
        return out

    def line(s, p, o):
        return F.concat_ws(" ", s, F.lit(f"<{p}>"), o, F.lit(".")).alias("value")

    return (
        kb.label.select(line(iri(F.col("item")), P_LABEL, lit(F.col("name"), F.col("lang"))))
        .unionByName(kb.redirect.select(line(iri(F.col("src")), P_REDIRECT, iri(F.col("dst")))))
        .unionByName(kb.disambig.select(line(iri(F.col("page")), P_DISAMBIG, iri(F.col("item")))))
        .unionByName(kb.type.select(line(iri(F.col("item")), P_TYPE, iri(expand(F.col("class"))))))
        .unionByName(kb.link.select(line(iri(F.col("source")), P_LINK, iri(F.col("target")))))
        .unionByName(kb.topic.select(line(iri(F.col("item")), P_TOPIC, iri(F.col("page")))))
    )


# Saved SPARQL JSON results (D10) ------------------------------------------
SPARQL_JSON_SCHEMA = (
    "head struct<vars: array<string>>, results struct<bindings: array<struct<"
    "item: struct<value: string>, name: struct<value: string>, "
    "page: struct<value: string>, count: struct<value: string>>>>"
)


def read_sparql_results(spark: SparkSession, path: str) -> DataFrame:
    """Saved endpoint answers -> (file, item, name, page, cnt) rows.

    One JSON document per file (multi-line); ``count`` arrives as text.
    """
    raw = spark.read.schema(SPARQL_JSON_SCHEMA).json(path, multiLine=True)
    b = raw.select(F.col("_metadata.file_path").alias("file"), F.explode("results.bindings").alias("b"))
    return b.select(
        "file",
        F.col("b.item.value").alias("item"),
        F.col("b.name.value").alias("name"),
        F.col("b.page.value").alias("page"),
        F.col("b.count.value").cast("bigint").alias("cnt"),
    )


BACKLINKS_JSON_SCHEMA = "query struct<backlinks: array<struct<pageid: bigint, ns: int, title: string>>>"


def read_backlink_answers(spark: SparkSession, path: str) -> DataFrame:
    """L2: saved backlink answers -> (title, from_page, ns), the table ``link.most_popular`` reads.

    One JSON document per file, named ``<page title>.json`` with blanks as
    underscores.  An answer without a ``query`` part gives no rows, so its page drops out there.
    """
    raw = spark.read.schema(BACKLINKS_JSON_SCHEMA).json(path, multiLine=True)
    title = F.url_decode(F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.json$", ""))
    return raw.select(title.alias("title"), F.explode("query.backlinks").alias("b")).select(
        "title", F.col("b.title").alias("from_page"), F.col("b.ns").alias("ns"))
