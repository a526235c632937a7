"""Derived inputs built from the driver tables (documents, pages, labels).

Each builder is one Spark expression whose twin SQL lives next to the
queries; both engines must produce the same rows.  The rules (FIXTURES.md):

* words: split ``text`` on ``[ \\n]+``, keep ``^\\p{Lu}\\p{Ll}{3,}[.,]?\\z``, strip
  one trailing ``[.,]``;
* titles: the first two to six tokens of every text, as written;
* knowledge graph from the distinct words of length >= 5 and the titles;
* mentions: every word of a text, NER label by ``length % 4``;
* WARC payloads: one record per page, fixed header layout;
* POS tokens: tokens per sentence, tag by a length rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.plan import compute_once
from trawl.sources.kb import RESOURCE, TABLES, KnowledgeGraph

WIKI = "http://en.wikipedia.org/wiki/"

# Fixture NER labels by length % 4, classes by length % 3.
MENTION_LABELS = ["PERSON", "GPE", "PRODUCT", "CARDINAL"]
ITEM_CLASSES = ["dbo:Person", "geo:SpatialThing", "owl:Thing"]
TITLE_CLASSES = ["dbo:Work", "dbo:Event"]
# Fixture POS letters by token length % 12.
POS_LETTERS = ["V", "T", "R", "J", "N", "O", "D", "P", "X", "M", "V", "N"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, pos, word) for every capitalised word of every text."""
    toks = docs.select(F.col(key_col).alias("key"), F.posexplode(F.split(text_col, r"[ \n]+", -1)).alias("pos", "tok"))
    return toks.where(F.col("tok").rlike(r"^\p{Lu}\p{Ll}{3,}[.,]?\z")).select(
        "key", "pos", F.regexp_replace("tok", r"[.,]\z", "").alias("word")
    )


def titles(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, name): the first ``2 + key % 5`` tokens of every text of two tokens or more, with blanks as written.

    Only the head of a text that can hold them is cut into tokens; a text without a key is its own name.
    """
    from trawl.operators.annotate import leading_tokens, page_tokens
    from trawl.operators.names import spaced_text

    key, text = F.col(key_col), F.col(text_col)
    heads = docs.select(key.alias("key"), F.when(key.isNull(), text).otherwise(leading_tokens(text, 6)).alias("text"))
    t = page_tokens(heads).where(F.size("tokens") >= 2)
    n = F.least(F.size("tokens"), (F.lit(2) + F.pmod("key", F.lit(5))).cast("int"))
    return t.select("key", spaced_text(F.col("tokens"), F.col("ws"), F.lit(0), n).alias("name"))


def mentions(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, pos, mention, label): rule NER over whole texts."""
    labels = F.array(*[F.lit(x) for x in MENTION_LABELS])
    w = words(docs, key_col, text_col)
    return w.select("key", "pos", F.col("word").alias("mention"),
                    F.element_at(labels, (F.length("word") % 4 + 1).cast("int")).alias("label"))


def derived_kb(docs: DataFrame, long_words: DataFrame | None = None, title_rows: DataFrame | None = None,
               word_set: DataFrame | None = None) -> KnowledgeGraph:
    """The knowledge graph built from the words and titles of ``documents``.

    ``long_words``: the (key, pos, word) rows of length >= 5, ``title_rows``: the (key, name)
    rows of ``titles``, ``word_set``: the distinct words, when already materialised (the build then scans the texts only once).
    Words whose length leaves 1 on division by 4 have a second class; so have titles of even length.
    """
    w = long_words if long_words is not None else words(docs).where(F.length("word") >= 5)
    t = (title_rows if title_rows is not None else titles(docs)).withColumn(
        "item", F.concat(F.lit(RESOURCE + "title_"), F.md5(F.col("name").cast("binary"))))
    named = t.select("item", "name").distinct()
    items = w.select("word").distinct() if word_set is None else word_set
    item = F.concat(F.lit(RESOURCE), F.col("word"))
    classes = F.array(*[F.lit(x) for x in ITEM_CLASSES])
    label = items.select(item.alias("item"), F.col("word").alias("name"), F.lit("en").alias("lang")).unionByName(
        items.select(item.alias("item"), F.lower("word").alias("name"), F.lit("fr").alias("lang"))
    ).unionByName(named.select("item", "name", F.lit("en").alias("lang")))

    def class_of(n):
        return F.element_at(classes, (n % 3 + 1).cast("int")).alias("class")

    n = F.length("word")
    typ = items.select(item.alias("item"), class_of(n)).unionByName(
        items.where(n % 4 == 1).select(item.alias("item"), class_of(n + 1))).unionByName(
        named.select("item", F.lit(TITLE_CLASSES[0]).alias("class"))).unionByName(
        named.where(F.length("name") % 2 == 0).select("item", F.lit(TITLE_CLASSES[1]).alias("class")))
    topic = items.select(item.alias("item"), F.concat(F.lit(WIKI), "word").alias("page")).unionByName(
        named.select("item", F.concat(F.lit(WIKI + "title_"), F.md5(F.col("name").cast("binary"))).alias("page")))
    source = F.concat(F.lit(RESOURCE + "doc_"), F.col("key").cast("string")).alias("source")
    link = w.select(source, item.alias("target")).unionByName(t.select(source, F.col("item").alias("target"))).distinct()
    head = F.substring("word", 1, 4)
    disambig = items.select(
        F.concat(F.lit(RESOURCE), head, F.lit("_(disambiguation)")).alias("page"), item.alias("item")
    ).unionByName(
        items.where(F.length("word") % 2 == 0).select(F.concat(F.lit(RESOURCE), head).alias("page"), item.alias("item"))
    )
    short = items.select(F.col("word").alias("short"))
    redirect = (
        items.where(F.length("word") >= 7)
        .withColumn("short", F.expr("substring(word, 1, length(word) - 2)"))
        .join(short, "short")
        .select(item.alias("src"), F.concat(F.lit(RESOURCE), "short").alias("dst"))
    )
    return KnowledgeGraph(label=label, redirect=redirect, disambig=disambig, type=typ, link=link, topic=topic)


def warc_payloads(pages: DataFrame) -> DataFrame:
    """(page_id, payload): one WARC response record per page, marker line excluded.

    ``page_id % 10 = 3`` carries no key line, ``page_id % 10 = 7`` is not
    HTML, so F1/F2 have something to reject.
    """
    pid = F.col("page_id")
    key_line = F.when(pid % 10 == 3, F.lit("X-TREC-ID: none")).otherwise(
        F.concat(F.lit("WARC-TREC-ID: fixture-"), F.lpad(pid.cast("string"), 8, "0"))
    )
    ctype = F.when(pid % 10 == 7, F.lit("Content-Type: image/png")).otherwise(
        F.lit("Content-Type: text/html; charset=UTF-8")
    )
    payload = F.concat_ws(
        "\n",
        F.lit("WARC-Type: response"),
        F.lit("WARC-Date: 2012-02-10T21:49:39Z"),
        key_line,
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.lit("WARC-Payload-Digest: sha1:0"),
        F.lit("WARC-IP-Address: 127.0.0.1"),
        F.concat(F.lit("WARC-Record-ID: "), pid.cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.length("html").cast("string")),
        F.lit(""),
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Server: fixture"),
        ctype,
        F.lit(""),
        F.col("html"),
    )
    return pages.select("page_id", payload.alias("payload"))


def pos_sentences(docs: DataFrame) -> DataFrame:
    """(key, sent, tokens, pos): all texts split on ``'. '``, tokens on blanks.

    POS letters: ``X`` (proper noun) for a capitalised token, else the
    letter at ``length % 12`` of the fixed list.  Letters: V verb, T
    particle, R adverb, J adjective, N noun, O pronoun, D determiner, P
    adposition, X proper noun / other, M number.
    """
    letters = F.array(*[F.lit(x) for x in POS_LETTERS])
    sents = docs.select(
        F.col("doc_id").alias("key"), F.posexplode(F.split("text", r"\. ", -1)).alias("sent", "s")
    )
    bare = F.btrim("s", F.lit(" \n"))  # so that no token is empty
    toks = compute_once(sents, keep=["key", "sent"], tokens=F.when(bare != "", F.split(bare, r"[ \n]+", -1)))
    tags = F.transform(
        "tokens",
        lambda t: F.when((t >= "A") & (t < "["), F.lit("X")).otherwise(F.element_at(letters, (F.length(t) % 12 + 1).cast("int"))),
    )
    return toks.where(F.size("tokens") > 0).select("key", F.col("sent").cast("bigint").alias("sent"), "tokens",
                                                   F.array_join(tags, "").alias("pos"))


def pos_entities(sents: DataFrame) -> DataFrame:
    """Entities of the POS fixture: each capitalised token, trailing ``[.,]`` stripped.

    Adds ``ents array<struct<start int, end int, text string>>`` (0-based
    token span, end exclusive), sorted by start.
    """
    def bare(t):
        return F.when(F.right(t, F.lit(1)).isin(".", ","), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t)

    zipped = F.arrays_zip(F.col("tokens").alias("t"), F.split("pos", "", -1).alias("p"),
                          F.sequence(F.lit(0), F.size("tokens") - 1).alias("i"))
    ents = F.transform(
        F.filter(zipped, lambda z: z["p"] == "X"),
        lambda z: F.struct(z["i"].alias("start"), (z["i"] + 1).alias("end"), bare(z["t"]).alias("text")),
    )
    return sents.withColumn("ents", ents)


KB_LAYOUT = "4"  # bump when the stored table set changes


def stored_kb(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> KnowledgeGraph:
    """The derived knowledge graph, written once as parquet and read back.

    A real graph is loaded from storage, never rebuilt per query; the
    derived one is written under the session's checkpoint folder (a shared
    folder on a cluster), keyed by the input path, size and time, and reused
    by later queries.  Existence checks go through the Hadoop file system of
    the path, so they work for any shared store, not only local disks.
    """
    import hashlib

    from trawl.session import ensure_checkpoint_dir, path_status, rename_path

    src = f"{sf_dir}/documents.parquet"
    size, mtime = path_status(spark, src)
    tag = hashlib.sha1(f"{KB_LAYOUT}|{src}|{size}|{mtime}".encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark)}/trawl-kb-{tag}"
    tables = [*TABLES, "lookup", "item_cards"]
    if any(path_status(spark, f"{path}/kb_{t}/_SUCCESS")[0] is None for t in tables):
        # Build under a private name, then rename into place: concurrent
        # builders never see each other's half-written files.
        import uuid

        tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
        docs = spark.read.parquet(src)
        par = spark.sparkContext.defaultParallelism
        docs = docs.repartition(par) if docs.rdd.getNumPartitions() < par else docs
        words(docs).where(F.length("word") >= 5).write.mode("overwrite").parquet(f"{tmp}/words")
        titles(docs).write.mode("overwrite").parquet(f"{tmp}/titles")
        long_words = spark.read.parquet(f"{tmp}/words")
        long_words.select("word").distinct().write.mode("overwrite").parquet(f"{tmp}/word_set")
        derived_kb(docs, long_words, spark.read.parquet(f"{tmp}/titles"), spark.read.parquet(f"{tmp}/word_set")).save(
            tmp, partitions or max(8, par))
        rename_path(spark, tmp, path)  # False when another builder won the race: its copy is used
    return KnowledgeGraph.load(spark, path)
