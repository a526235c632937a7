"""Registered queries (Spark) and their DuckDB twins.

Each query reads the driver tables under ``sf_dir`` (or data Spark derives
from them) and runs over whole tables and whole texts.  Every computed
column is aliased to the same name on both sides; integer outputs are
BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions import text as T
from trawl.operators import candidates as C
from trawl.operators import link as L
from trawl.operators.pages import page_rows, pages_as_bodies
from trawl.operators.records import html_records
from trawl.plans import fixtures as fx
from trawl.plans import sqltext as S
from trawl.session import stored
from trawl.sources import kb as K

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def rebalance(df: DataFrame) -> DataFrame:
    """Spread an under-parallel input (one big file, one gzip) over all cores.

    A no-op when the scan already yields at least one split per core, which
    is the normal case at scale, so no extra shuffle of the corpus there.
    """
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebalance(fx.read_table(spark, sf_dir, "documents"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebalance(fx.read_table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------------------
# Records (F1-F4) and pages (H2-H5)
# ---------------------------------------------------------------------------
_PAYLOAD_SQL = r"""
rec AS (
  SELECT page_id, concat_ws(chr(10), 'WARC-Type: response', 'WARC-Date: 2012-02-10T21:49:39Z',
    CASE WHEN page_id % 10 = 3 THEN 'X-TREC-ID: none'
         ELSE 'WARC-TREC-ID: fixture-' || lpad(CAST(page_id AS VARCHAR), 8, '0') END,
    'WARC-Target-URI: ' || url, 'WARC-Payload-Digest: sha1:0', 'WARC-IP-Address: 127.0.0.1',
    'WARC-Record-ID: ' || CAST(page_id AS VARCHAR), 'Content-Type: application/http; msgtype=response',
    'Content-Length: ' || CAST(length(html) AS VARCHAR), '', 'HTTP/1.1 200 OK', 'Server: fixture',
    CASE WHEN page_id % 10 = 7 THEN 'Content-Type: image/png' ELSE 'Content-Type: text/html; charset=UTF-8' END,
    '', html) AS payload
  FROM pages
)"""

_SPLITLINES = (
    "CASE WHEN {s} = '' THEN []::VARCHAR[] "
    "WHEN regexp_matches({s}, '(?:" + S.LINE_BREAK + ")$') "
    "THEN (string_split_regex({s}, '" + S.LINE_BREAK + "'))[1:-2] "
    "ELSE string_split_regex({s}, '" + S.LINE_BREAK + "') END"
)

_WARC_SQL = (
    "WITH " + _PAYLOAD_SQL.strip() + r""",
lines AS (SELECT page_id, payload, """ + _SPLITLINES.replace("{s}", "payload") + r""" AS l FROM rec),
parts AS (
  SELECT page_id, payload,
         CASE WHEN starts_with(l[3], 'WARC-TREC-ID') THEN string_split(l[3], ': ')[2] END AS key,
         l[11:] AS h
  FROM lines
),
heads AS (SELECT *, list_position(h, '') AS blank FROM parts),
recs AS (
  SELECT page_id, payload, key,
    len(list_filter(CASE WHEN blank IS NOT NULL THEN h[1:blank] ELSE h END,
        lambda x: starts_with(lower(x), 'content-type') AND contains(lower(x), 'html'))) > 0 AS is_html,
    CASE WHEN blank IS NOT NULL THEN h[blank + 1:] ELSE []::VARCHAR[] END AS body
  FROM heads
)
SELECT key, array_to_string(body, ' ') AS body FROM recs
WHERE length(payload) > 0 AND key IS NOT NULL AND is_html"""
)


@register("warc_pages", _WARC_SQL)
def q_warc_pages(spark, sf_dir):
    """F1-F4 over one WARC record per page (key line and content type vary)."""
    recs = fx.warc_payloads(pages(spark, sf_dir))
    return html_records(recs, "payload").select("key", "body")


_CLOSERS = "p|article|body|html|div|section|footer|nav|main|li|ul|ol|td|tr|table|blockquote"
_HTML_CTES = r"""
b0 AS (
  SELECT page_id, regexp_replace(html, '""" + S.LINE_BREAK + r"""', ' ', 'g') AS r,
         regexp_matches(html, '(?:""" + S.LINE_BREAK + r""")$') AS tb FROM pages
),
b1 AS (SELECT page_id, CASE WHEN tb THEN substr(r, 1, length(r) - 1) ELSE r END AS body FROM b0),
u AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(body, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&middot;?', '·', 'g'),
    '&copy;?', '©', 'g'), '&nbsp;?', ' ', 'g'), '&amp;?', '&', 'g') AS h
  FROM b1
),
c AS (
  SELECT page_id, regexp_replace(regexp_replace(h, '<!--.*?-->', '', 'g'),
    '<(script|style)(?:\s[^>]*)?>.*?</(?:script|style)\s*>', '', 'g') AS h FROM u
),
parts AS (
  SELECT page_id,
    CASE WHEN contains(t, '<') THEN '' ELSE t END AS title,
    list_transform(regexp_extract_all(h, '<h[1-6](?:\s[^>]*)?>(.*?)</h[1-6]\s*>', 1),
                   lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) AS headers,
    list_transform((string_split_regex(h, '<p(?:\s[^>]*)?>'))[2:],
                   lambda x: regexp_replace(regexp_extract(x, '^(.*?)(?:</(?:""" + _CLOSERS + r""")\s*>|$)', 1),
                                            '<[^>]*>', '', 'g')) AS paras
  FROM (SELECT page_id, h, regexp_extract(h, '<title(?:\s[^>]*)?>(.*?)</title\s*>', 1) AS t FROM c)
)"""


def _page_parts(spark, sf_dir, p_mode="autoclose"):
    from trawl.functions.html import extract_html

    return extract_html(pages_as_bodies(pages(spark, sf_dir)), "key", "body", p_mode)


@register("page_title", "WITH " + _HTML_CTES.strip() + f"""
SELECT page_id, {S.process_text('title')} AS title FROM parts""")
def q_page_title(spark, sf_dir):
    """H2 + T4: processed page title."""
    p = _page_parts(spark, sf_dir)
    return p.select(F.col("key").alias("page_id"), T.process_text(F.col("title")).alias("title"))


@register("page_headers", "WITH " + _HTML_CTES.strip() + f"""
SELECT page_id, {S.process_text(S.join_sentences('headers'))} AS headers FROM parts""")
def q_page_headers(spark, sf_dir):
    """H3 + T1 + T4: processed header texts."""
    p = _page_parts(spark, sf_dir)
    return p.select(F.col("key").alias("page_id"),
                    T.process_text(T.join_sentences(F.col("headers"))).alias("headers"))


@register("page_paragraphs", "WITH " + _HTML_CTES.strip() + """
SELECT page_id, CAST(generate_subscripts(paras, 1) - 1 AS BIGINT) AS para_no, unnest(paras) AS para FROM parts""")
def q_page_paragraphs(spark, sf_dir):
    """H4 (autoclose): raw paragraph texts in document order."""
    p = _page_parts(spark, sf_dir)
    return p.select(F.col("key").alias("page_id"), F.posexplode("paras").alias("para_no", "para")).select(
        "page_id", F.col("para_no").cast("bigint").alias("para_no"), "para")


_PAGE_TEXT_SQL = "WITH " + _HTML_CTES.strip() + f""",
proc AS (
  SELECT page_id, {S.process_text('title')} AS title,
         {S.process_text(S.join_sentences('headers'))} AS headers,
         {S.process_text(S.join_sentences('list_concat(headers, paras)'))} AS all_text
  FROM parts
)
SELECT page_id AS key, title, headers, trim(title || ' ' || all_text) AS text FROM proc
WHERE length(trim(title || ' ' || all_text)) > 0"""


@register("page_text", _PAGE_TEXT_SQL)
def q_page_text(spark, sf_dir):
    """H5 + F5: (key, title, headers, text) per page, autoclose paragraphs."""
    return page_rows(pages_as_bodies(pages(spark, sf_dir)), p_mode="autoclose")


@register("page_text_nested")
def q_page_text_nested(spark, sf_dir):
    """H5 with the original nesting of unclosed paragraphs (rows-only check)."""
    return page_rows(pages_as_bodies(pages(spark, sf_dir)), p_mode="nested")


# ---------------------------------------------------------------------------
# Text functions T1-T8 over documents
# ---------------------------------------------------------------------------
@register("join_sentences", f"""
SELECT doc_id, {S.join_sentences("string_split(text, chr(10))")} AS joined FROM documents""")
def q_join_sentences(spark, sf_dir):
    """T1 over the lines of each text."""
    return docs(spark, sf_dir).select("doc_id", T.join_sentences(F.split("text", "\n", -1)).alias("joined"))


@register("valid_words", f"""
SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda w: {S.valid('w')}), ' ') AS valid
FROM documents""")
def q_valid_words(spark, sf_dir):
    """The words that pass the first-character rule."""
    ws = F.filter(F.split("text", " ", -1), lambda w: T.is_valid_word(w))
    return docs(spark, sf_dir).select("doc_id", F.array_join(ws, " ").alias("valid"))


@register("sanitize_words", f"""
SELECT doc_id, {S.kept_words('text')} AS sanitized FROM documents""")
def q_sanitize_words(spark, sf_dir):
    """T2 + T3: valid words with one trailing symbol removed."""
    ws = F.transform(F.filter(F.split("text", " ", -1), lambda w: T.is_valid_word(w)), T.sanitize_word)
    return docs(spark, sf_dir).select("doc_id", F.array_join(ws, " ").alias("sanitized"))


@register("process_text", f"""
SELECT doc_id, {S.process_text('text')} AS processed FROM documents""")
def q_process_text(spark, sf_dir):
    """T4/T5: whole-text processing."""
    return docs(spark, sf_dir).select("doc_id", T.process_text(F.col("text")).alias("processed"))


_LINES_SQL = """
lines AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
)"""


def _lines(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return d.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line")


@register("mention_keys", "WITH " + _LINES_SQL.strip() + f"""
SELECT doc_id, line_no, {S.mention_key('line')} AS mention_key FROM lines""")
def q_mention_keys(spark, sf_dir):
    """T6 over every line."""
    return _lines(spark, sf_dir).select("doc_id", "line_no", T.mention_key(F.col("line")).alias("mention_key"))


@register("mention_forms", "WITH " + _LINES_SQL.strip() + f""",
f0 AS (SELECT doc_id, line_no, {S.m0('line')} AS m0 FROM lines),
f1 AS (SELECT *, {S.title_case('m0')} AS m2 FROM f0)
SELECT doc_id, line_no, m0, replace(m0, ' ', '_') AS m1, m2, replace(m2, ' ', '_') AS m3 FROM f1""")
def q_mention_forms(spark, sf_dir):
    """T7 (with T8) over every line treated as a mention."""
    return T.with_mention_forms(_lines(spark, sf_dir), "line", ["doc_id", "line_no"])


@register("title_case", "WITH " + _LINES_SQL.strip() + f""",
low AS (SELECT doc_id, line_no, lower(line) AS s FROM lines)
SELECT doc_id, line_no, {S.title_case('s')} AS titled FROM low""")
def q_title_case(spark, sf_dir):
    """T8 on lower-cased lines (small words inside stay lower case)."""
    return _lines(spark, sf_dir).select("doc_id", "line_no", T.title_case(F.lower("line")).alias("titled"))


# ---------------------------------------------------------------------------
# Mentions, knowledge graph, candidates, linking
# ---------------------------------------------------------------------------
def _mentions(spark, sf_dir):
    return fx.mentions(docs(spark, sf_dir))


def _kb(spark, sf_dir):
    return fx.stored_kb(spark, sf_dir)


def _ments(spark, sf_dir):
    return L.distinct_mentions(_mentions(spark, sf_dir), L.label_class_table(spark))


def _reps(spark, sf_dir):
    return _ments(spark, sf_dir).groupBy("mention_key", "class").agg(F.min("mention").alias("rep"))


@register("label_class", S.with_ctes(S.WORDS, S.MENTIONS, S.LABEL_CLASS) + """
SELECT m.key, m.pos, m.mention, m.label, c.class FROM mentions m JOIN label_class c ON c.label = m.label""")
def q_label_class(spark, sf_dir):
    """mapped labels only, with their class."""
    m = _mentions(spark, sf_dir).select("key", F.col("pos").cast("bigint").alias("pos"), "mention", "label")
    return L.with_class(m, L.label_class_table(spark)).select("key", "pos", "mention", "label", "class")


@register("distinct_mentions", S.with_ctes(S.WORDS, S.MENTIONS, S.LABEL_CLASS, S.MENTS) + """
SELECT key, mention, label, class, mention_key FROM ments""")
def q_distinct_mentions(spark, sf_dir):
    """L4 + T6: distinct mentions per page with class and key."""
    return _ments(spark, sf_dir).select("key", "mention", "label", "class", "mention_key")


@register("cand_label", S.with_ctes(*S.LINK_CTES) + """
SELECT mention_key, class, rep, item, branch, COUNT(*) AS n FROM branches WHERE branch = 'label' GROUP BY ALL""")
def q_cand_label(spark, sf_dir):
    """C1 (+C5): label hits per distinct mention."""
    rows = C.branch_rows(_reps(spark, sf_dir), _kb(spark, sf_dir)).where(F.col("branch") == "label")
    return rows.groupBy(*C.KEYS, "item", "branch").agg(F.count(F.lit(1)).alias("n"))


@register("cand_redirect", S.with_ctes(*S.LINK_CTES) + """
SELECT mention_key, class, rep, item, branch, COUNT(*) AS n FROM branches WHERE branch = 'redirect' GROUP BY ALL""")
def q_cand_redirect(spark, sf_dir):
    """C2 (+C5): label hit, then zero or one redirect."""
    rows = C.branch_rows(_reps(spark, sf_dir), _kb(spark, sf_dir)).where(F.col("branch") == "redirect")
    return rows.groupBy(*C.KEYS, "item", "branch").agg(F.count(F.lit(1)).alias("n"))


@register("cand_disambig", S.with_ctes(*S.LINK_CTES) + """
SELECT mention_key, class, rep, item, branch, COUNT(*) AS n FROM branches
WHERE branch IN ('disambig_page', 'disambig_self') GROUP BY ALL""")
def q_cand_disambig(spark, sf_dir):
    """C3 + C4 (+C5): disambiguation pages."""
    rows = C.branch_rows(_reps(spark, sf_dir), _kb(spark, sf_dir)).where(F.col("branch").startswith("disambig"))
    return rows.groupBy(*C.KEYS, "item", "branch").agg(F.count(F.lit(1)).alias("n"))


@register("cand_all", S.with_ctes(*S.LINK_CTES) + """
SELECT mention_key, class, rep, item, mult FROM mult""")
def q_cand_all(spark, sf_dir):
    """The branch bag, as multiplicity per item."""
    rows = C.branch_rows(_reps(spark, sf_dir), _kb(spark, sf_dir))
    return rows.groupBy(*C.KEYS, "item").agg(F.count(F.lit(1)).alias("mult"))


@register("cand_count", S.with_ctes(*S.LINK_CTES) + """
SELECT mention_key, class, rep, item, name, page, cnt FROM cands""")
def q_cand_count(spark, sf_dir):
    """Class filter, in-links, page, English name, count."""
    return C.candidates(_reps(spark, sf_dir), _kb(spark, sf_dir))


@register("most_referred", S.with_ctes(*S.LINK_CTES) + """
SELECT mention_key, class, rep, link FROM best""")
def q_most_referred(spark, sf_dir):
    """L1 + T9: max count, then min edit distance, then min page."""
    return L.most_referred(C.candidates(_reps(spark, sf_dir), _kb(spark, sf_dir)))


@register("most_similar", S.with_ctes(*S.LINK_CTES) + """
SELECT mention_key, class, rep, name, page FROM (
  SELECT *, row_number() OVER (PARTITION BY mention_key, class, rep
                               ORDER BY """ + S.distance("rep", "name") + """, page, name) AS rn FROM cands)
WHERE rn = 1""")
def q_most_similar(spark, sf_dir):
    """L3: nearest candidate name by edit distance."""
    return L.most_similar(C.candidates(_reps(spark, sf_dir), _kb(spark, sf_dir)))


_BACKLINKS_SQL = """
backlinks AS (
  SELECT DISTINCT w.word AS title, 'doc_' || CAST(w.key AS VARCHAR) AS from_page,
         CASE WHEN d.lang = 'en' THEN 4 ELSE 0 END AS ns
  FROM words w JOIN documents d ON d.doc_id = w.key WHERE length(w.word) >= 5
)"""


def backlinks_table(d: DataFrame) -> DataFrame:
    """Backlinks derived from the texts: a page links to each word it uses.

    ``ns`` = 4 (project namespace) for English texts, 0 otherwise.
    """
    w = fx.words(d).where(F.length("word") >= 5)
    return (
        w.join(d.select(F.col("doc_id").alias("key"), "lang"), "key")
        .select(F.col("word").alias("title"), F.concat(F.lit("doc_"), F.col("key").cast("string")).alias("from_page"),
                F.when(F.col("lang") == "en", 4).otherwise(0).alias("ns"))
        .distinct()
    )


@register("most_popular", S.with_ctes(*S.LINK_CTES, _BACKLINKS_SQL) + """,
counts AS (SELECT title, COUNT(*) AS backlinks FROM backlinks WHERE ns = 4 GROUP BY title),
ranked AS (
  SELECT c.*, k.backlinks FROM cands c
  JOIN counts k ON k.title = (string_split(c.page, '/'))[-1]
)
SELECT mention_key, class, rep, name, page, item, backlinks FROM (
  SELECT *, row_number() OVER (PARTITION BY mention_key, class, rep
                               ORDER BY backlinks DESC, """ + S.distance("rep", "name") + """, page) AS rn FROM ranked)
WHERE rn = 1""")
def q_most_popular(spark, sf_dir):
    """L2: most backlinks from the project namespace, ties by edit distance."""
    d = docs(spark, sf_dir)
    cands = C.candidates(_reps(spark, sf_dir), _kb(spark, sf_dir))
    return L.most_popular(cands, backlinks_table(d))


@register("link_entities", S.with_ctes(*S.LINK_CTES) + """
SELECT key, mention, link FROM entities""")
def q_link_entities(spark, sf_dir):
    """L5 + L6: linked mentions per page."""
    ents, _ = L.link_entities(_mentions(spark, sf_dir), _kb(spark, sf_dir), L.label_class_table(spark))
    return ents


@register("link_cache_miss", S.with_ctes(*S.LINK_CTES) + """,
store_keys AS (
  SELECT DISTINCT m.mention_key, m.class FROM ments m JOIN labels l ON l.doc_id = m.key WHERE l.quality = 1
),
todo AS (
  SELECT m.* FROM ments m ANTI JOIN store_keys s ON s.mention_key = m.mention_key AND s.class = m.class
)
SELECT t.mention_key, t.class, t.rep, r.link FROM (
  SELECT mention_key, class, min(mention) AS rep FROM todo GROUP BY mention_key, class) t
LEFT JOIN best r ON r.mention_key = t.mention_key AND r.class = t.class AND r.rep = t.rep""")
def q_link_cache_miss(spark, sf_dir):
    """L5 with a store: only mentions missing from it are resolved (anti-join).

    The store holds what a first run over the good-quality texts resolved.
    """
    ments = _ments(spark, sf_dir)
    kb = _kb(spark, sf_dir)
    good = fx.read_table(spark, sf_dir, "labels").where(F.col("quality") == 1).select(F.col("doc_id").alias("key"))
    store = L.resolve_mentions(ments.join(good, "key", "left_semi"), kb)
    todo = ments.join(store.select("mention_key", "class"), ["mention_key", "class"], "left_anti")
    return L.resolve_mentions(todo, kb).select("mention_key", "class", "rep", "link")


@register("kb_from_triples", S.with_ctes(S.WORDS, S.KB) + """
SELECT 'label' AS tbl, item AS a, name AS b, lang AS c FROM kb_label
UNION ALL SELECT 'redirect', src, dst, '' FROM kb_redirect
UNION ALL SELECT 'disambig', page, item, '' FROM kb_disambig
UNION ALL SELECT 'type', item, class, '' FROM kb_type
UNION ALL SELECT 'link', source, target, '' FROM kb_link
UNION ALL SELECT 'topic', item, page, '' FROM kb_topic""")
def q_kb_from_triples(spark, sf_dir):
    """Write the derived graph as N-Triples lines, read it back into tables."""
    kb = K.from_triples(K.parse_ntriples(K.to_ntriples(_kb(spark, sf_dir))))
    e = F.lit("")
    return (
        kb.label.select(F.lit("label").alias("tbl"), F.col("item").alias("a"), F.col("name").alias("b"),
                        F.col("lang").alias("c"))
        .unionByName(kb.redirect.select(F.lit("redirect").alias("tbl"), F.col("src").alias("a"),
                                        F.col("dst").alias("b"), e.alias("c")))
        .unionByName(kb.disambig.select(F.lit("disambig").alias("tbl"), F.col("page").alias("a"),
                                        F.col("item").alias("b"), e.alias("c")))
        .unionByName(kb.type.select(F.lit("type").alias("tbl"), F.col("item").alias("a"),
                                    F.col("class").alias("b"), e.alias("c")))
        .unionByName(kb.link.select(F.lit("link").alias("tbl"), F.col("source").alias("a"),
                                    F.col("target").alias("b"), e.alias("c")))
        .unionByName(kb.topic.select(F.lit("topic").alias("tbl"), F.col("item").alias("a"),
                                     F.col("page").alias("b"), e.alias("c")))
    )


# ---------------------------------------------------------------------------
# Annotation N1-N5
# ---------------------------------------------------------------------------
from trawl.operators import abbrev as AB  # noqa: E402
from trawl.operators import annotate as N  # noqa: E402
from trawl.operators import tagger as TG  # noqa: E402
from trawl.operators.blocks import counted_tokens  # noqa: E402
from trawl.operators import relations as RL  # noqa: E402
from trawl.operators import score as E  # noqa: E402
from trawl.plans.linking import CLASS_LABELS, gazetteer  # noqa: E402
from trawl.sources import lines as LN  # noqa: E402

_TOK_RE_SQL = N.TOKEN_WS_RE.replace("'", "''")
_SENTS_SQL = r"""
tk AS (SELECT doc_id AS key, regexp_extract_all(text, '""" + _TOK_RE_SQL + r"""', 1) AS toks,
              regexp_extract_all(text, '""" + _TOK_RE_SQL + r"""', 2) AS wss FROM documents),
cl AS (
  SELECT key, toks, wss, string_split(regexp_replace(array_to_string(list_transform(toks,
      lambda t: CASE WHEN t IN ('.', '!', '?') THEN 'S' WHEN regexp_matches(t, '^[^\pL\pN]') THEN 'P' ELSE 'W' END),
      ''), 'S([SP]*)W', 'S\1B', 'g'), '') AS flags
  FROM tk WHERE len(toks) > 0
),
st AS (SELECT key, toks, wss, list_concat([0], list_filter(range(1, len(toks)), lambda i: flags[i + 1] = 'B')) AS starts
       FROM cl),
ss AS (
  SELECT key, CAST(generate_subscripts(sl, 1) - 1 AS BIGINT) AS sent, unnest(sl) AS stoks FROM (
    SELECT key, list_transform(starts, lambda s, j: toks[s + 1 : coalesce(starts[j + 1], len(toks))]) AS sl FROM st)
)"""


# Abbreviations: chunks between white space, counted by word with and without a dot; then the text with their dots marked.
_AB = {k: v.replace("'", "''") for k, v in (("chunk", AB.CHUNK_RE), ("dot", AB.DOTTED_RE), ("plain", AB.PLAIN_RE))}
_ABBREV_SQL = f"""
chunked AS (
  SELECT doc_id AS key, unnest(regexp_extract_all(text, '{_AB["chunk"]}', 1)) AS c,
         unnest(regexp_extract_all(text, '{_AB["chunk"]}', 2)) AS b,
         generate_subscripts(regexp_extract_all(text, '{_AB["chunk"]}', 1), 1) AS i
  FROM documents
),
typed AS (
  SELECT key, c, b, i, lower(regexp_extract(c, '{_AB["dot"]}', 1)) AS d, lower(regexp_extract(c, '{_AB["plain"]}', 1)) AS p FROM chunked
),
types AS (
  SELECT word, CAST(sum(dot) AS BIGINT) AS n_dot, CAST(sum(1 - dot) AS BIGINT) AS n_plain
  FROM (SELECT CASE WHEN d <> '' THEN d ELSE p END AS word, CASE WHEN d <> '' THEN 1 ELSE 0 END AS dot FROM typed)
  WHERE regexp_matches(word, '\\pL') GROUP BY word
),
rate AS (SELECT (sum(n_dot) + 0.5) / (sum(n_dot + n_plain) + 1.0) AS p0 FROM types),
weighed AS (
  SELECT word, n_dot, n_plain, length(replace(word, '.', '')) AS size,
         2 * (n_dot * (ln(0.99) - ln(p0)) + n_plain * (ln(0.01) - ln(1 - p0))) AS ratio
  FROM types, rate WHERE n_dot > 0
),
abbreviations AS (
  SELECT word, n_dot, n_plain, ratio * (length(word) - size + 1) * exp(-size - n_plain * ln(size)) AS score
  FROM weighed WHERE ratio * (length(word) - size + 1) * exp(-size - n_plain * ln(size)) >= {AB.THRESHOLD}
),
guarded AS (
  SELECT key, string_agg(CASE WHEN a.word IS NULL THEN c ELSE replace(c, '.', chr({ord(AB.MARK)})) END || b, '' ORDER BY i) AS text
  FROM typed LEFT JOIN abbreviations a ON a.word = d AND d <> '' GROUP BY key
)"""
_GUARDED_SENTS_SQL = _SENTS_SQL.replace("tk AS (SELECT doc_id AS key,", "tk AS (SELECT key,").replace(
    "AS wss FROM documents)", "AS wss FROM guarded)")


@register("abbreviations", S.with_ctes(_ABBREV_SQL) + " SELECT word, n_dot, n_plain, score FROM abbreviations")
def q_abbreviations(spark, sf_dir):
    """Word types whose dot belongs to them, learnt from all texts."""
    return AB.learn_abbreviations(docs(spark, sf_dir))


@register("sentences", S.with_ctes(_ABBREV_SQL, _GUARDED_SENTS_SQL) + f"""
SELECT key, sent, CAST(len(stoks) AS BIGINT) AS n_tokens, replace(array_to_string(stoks, ' '), chr({ord(AB.MARK)}), '.') AS sentence
FROM ss""")
def q_sentences(spark, sf_dir):
    """N1 + N2: rule tokens, sentence split after . ! ? tokens but not after learnt abbreviations, whole texts."""
    d = docs(spark, sf_dir)
    known = stored(AB.learn_abbreviations(d), "abbreviations")
    s = N.sentences(d, "doc_id", "text", known)
    return s.select("key", "sent", F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("sentence"))


_POS_SQL = r"""
ps AS (
  SELECT key, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS sent, unnest(l) AS s
  FROM (SELECT doc_id AS key, string_split(text, '. ') AS l FROM documents)
),
pt AS (SELECT key, sent, list_filter(string_split_regex(s, '[ \n]+'), lambda t: t <> '') AS tokens FROM ps),
pt2 AS (
  SELECT key, sent, tokens, array_to_string(list_transform(tokens, lambda t: CASE WHEN regexp_matches(t, '^[A-Z]')
      THEN 'X' ELSE (['V','T','R','J','N','O','D','P','X','M','V','N'])[length(t) % 12 + 1] END), '') AS pos
  FROM pt WHERE len(tokens) > 0
)"""


def _pos_sents(spark, sf_dir):
    return fx.pos_sentences(docs(spark, sf_dir))


_LEXICON_SQL = """
tagged AS (
  SELECT lower(tokens[i]) AS word, substr(pos, i, 1) AS tag
  FROM (SELECT tokens, pos, unnest(range(1, len(tokens) + 1)) AS i FROM pt2)
),
counts AS (SELECT word, tag, COUNT(*) AS n FROM tagged GROUP BY word, tag),
lexicon AS (SELECT word, tag, n FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, tag DESC) AS rn FROM counts) WHERE rn = 1)"""


@register("pos_lexicon", S.with_ctes(_POS_SQL, _LEXICON_SQL) + " SELECT word, tag, n FROM lexicon")
def q_pos_lexicon(spark, sf_dir):
    """Most frequent tag per word from the tagged texts."""
    return N.pos_lexicon(counted_tokens(_pos_sents(spark, sf_dir)), "t", n_col="n")


@register("pos_tags", S.with_ctes(_SENTS_SQL, _POS_SQL, _LEXICON_SQL) + r""",
tk2 AS (SELECT key, sent, unnest(range(1, len(stoks) + 1)) AS i, unnest(stoks) AS tok FROM ss),
ruled AS (
  SELECT key, sent, i, tok, CASE
    WHEN regexp_matches(tok, '^[^\pL\pN]+$') THEN 'U' WHEN regexp_matches(tok, '^\pN') THEN 'M'
    WHEN regexp_matches(tok, '^\p{Lu}') THEN 'X' WHEN regexp_matches(tok, 'ly$') THEN 'R'
    WHEN regexp_matches(tok, '(ing|ed|ize|ise)$') THEN 'V'
    WHEN regexp_matches(tok, '(ous|ful|ive|able|ible|al)$') THEN 'J' ELSE 'N' END AS rule
  FROM tk2
)
SELECT r.key, r.sent, string_agg(coalesce(l.tag, r.rule), '' ORDER BY r.i) AS pos
FROM ruled r LEFT JOIN lexicon l ON l.word = lower(r.tok) GROUP BY r.key, r.sent""")
def q_pos_tags(spark, sf_dir):
    """Every token of every sentence tagged by the lexicon, other words by rule."""
    sents = N.sentences(docs(spark, sf_dir), "doc_id", "text", ws=False)
    return N.tag_tokens(sents, q_pos_lexicon(spark, sf_dir), keep=["key", "sent"])


@register("pos_viterbi")
def q_pos_viterbi(spark, sf_dir):
    """Every sentence tagged by the cheapest path of a bigram model counted on the tagged texts."""
    d = docs(spark, sf_dir)
    sents = N.sentences(d, "doc_id", "text", ws=False)
    return TG.tag_in_context(sents, TG.train_tagger(fx.pos_sentences(d)), keep=["key", "sent"])


_GAZ_SQL = """
class_labels AS (SELECT * FROM (VALUES """ + ", ".join(f"('{c}', '{lb}')" for c, lb in CLASS_LABELS) + """) t(class, label)),
gaz AS (
  SELECT DISTINCT l.name, c.label FROM kb_label l JOIN kb_type t ON t.item = l.item
  JOIN class_labels c ON c.class = t.class WHERE l.lang = 'en'
)"""


# Every run of one to six tokens (the longest name of the graph) of a page that equals a name token by token.
_HITS_SQL = """
gaztok AS (
  SELECT DISTINCT array_to_string(regexp_extract_all(name, '""" + _TOK_RE_SQL + """', 1), ' ') AS text, label FROM gaz
),
grams AS (
  SELECT key, i AS beg, i + n AS stop, array_to_string(toks[i + 1 : i + n], ' ') AS text
  FROM (SELECT key, toks, i, unnest(range(1, 7)) AS n FROM (SELECT key, toks, unnest(range(0, len(toks))) AS i FROM tk))
  WHERE i + n <= len(toks)
),
found AS (SELECT g.key, g.beg, g.stop, z.label FROM grams g JOIN gaztok z ON z.text = g.text)"""


def _place_sql(name: str, source: str) -> str:
    """Hits (key, beg, stop, label) with the sentence they begin in, positions from there, and the text as written."""
    return f"""
{name} AS (
  SELECT h.key, h.beg, len(list_filter(s.starts, lambda x: x <= h.beg)) - 1 AS sent, h.label,
         h.beg - list_max(list_filter(s.starts, lambda x: x <= h.beg)) AS start,
         h.stop - list_max(list_filter(s.starts, lambda x: x <= h.beg)) AS stop,
         {S.spaced('s.toks', 's.wss', 'h.beg + 1', 'h.stop')} AS mention
  FROM {source} h JOIN st s ON s.key = h.key
)"""


def longest_sql(found: str, group: str) -> str:
    """The spans (beg, stop, label) of each group in order of choice; one that meets a kept one falls away."""
    return f"""
longest AS (
  SELECT {group}, s[1].beg AS beg, s[1].stop AS stop, s[1].label AS label FROM (
    SELECT {group}, unnest(list_transform(list_reduce(
      list([{{'beg': beg, 'stop': stop, 'label': label}}] ORDER BY stop - beg DESC, beg, label),
      lambda a, b: CASE WHEN len(list_filter(a, lambda x: x.beg < b[1].stop AND b[1].beg < x.stop)) > 0 THEN a
                        ELSE list_concat(a, b) END), lambda x: [x])) AS s
    FROM {found} GROUP BY {group})
)"""


_MENTION_COLS = ('key, CAST(sent AS BIGINT) AS sent, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS "end", mention, label')


def _gazetteer_hits(spark, sf_dir):
    toks = N.page_tokens(docs(spark, sf_dir), "doc_id", "text")
    return N.gazetteer_mentions(toks, gazetteer(spark, _kb(spark, sf_dir)))


def _mention_columns(hits):
    return hits.select("key", "sent", F.col("start").cast("bigint").alias("start"),
                       F.col("end").cast("bigint").alias("end"), "mention", "label")


@register("gazetteer_hits", S.with_ctes(S.WORDS, S.KB, _GAZ_SQL, _SENTS_SQL, _HITS_SQL, _place_sql("placed", "found")) + f"""
SELECT {_MENTION_COLS} FROM placed""")
def q_gazetteer_hits(spark, sf_dir):
    """Token runs that equal a known English name (label from class), across sentence ends."""
    return _mention_columns(_gazetteer_hits(spark, sf_dir))


@register("longest_spans", S.with_ctes(S.WORDS, S.KB, _GAZ_SQL, _SENTS_SQL, _HITS_SQL, longest_sql("found", "key"),
                                       _place_sql("placed", "longest")) + f"""
SELECT {_MENTION_COLS} FROM placed""")
def q_longest_spans(spark, sf_dir):
    """Longest-first non-overlapping mentions of each page."""
    return _mention_columns(N.longest_mentions(_gazetteer_hits(spark, sf_dir)))


# N3 with one label: mentions of names with one label teach the words around a label.
AROUND = 4
_AROUND_SQL = f"""
named_labels AS (SELECT text, count(*) AS n_labels FROM gaztok GROUP BY text),
ctx AS (
  SELECT f.key, f.beg, f.stop, z.label, l.n_labels, list_transform(list_filter(
           list_concat(s.toks[greatest(f.beg - {AROUND}, 0) + 1 : f.beg], s.toks[f.stop + 1 : f.stop + {AROUND}]),
           lambda t: regexp_matches(t, '^[\\pL\\pN]')), lambda t: lower(t)) AS context
  FROM (SELECT key, beg, stop, text FROM grams WHERE text IN (SELECT text FROM gaztok)) f
  JOIN gaztok z ON z.text = f.text JOIN named_labels l ON l.text = f.text JOIN st s ON s.key = f.key
),
near AS (SELECT label, word, count(*) AS c FROM (SELECT label, unnest(context) AS word FROM ctx WHERE n_labels = 1) GROUP BY label, word),
overall AS (SELECT (SELECT count(DISTINCT word) FROM near) AS v, (SELECT count(*) FROM ctx WHERE n_labels = 1) AS total,
                (SELECT count(DISTINCT label) FROM ctx) AS k),
stats AS (
  SELECT a.label, CAST(floor(ln((coalesce(m, 0) + 1) / CAST(total + k AS DOUBLE)) * 1000000) AS BIGINT) AS prior,
         CAST(coalesce(t, 0) + v + 1 AS DOUBLE) AS total_near
  FROM (SELECT DISTINCT label FROM ctx) a
  LEFT JOIN (SELECT label, count(*) AS m FROM ctx WHERE n_labels = 1 GROUP BY label) b ON b.label = a.label
  LEFT JOIN (SELECT label, sum(c) AS t FROM near GROUP BY label) d ON d.label = a.label, overall
),
sums AS (
  SELECT o.key, o.beg, o.stop, o.label, sum(CAST(floor(ln((coalesce(c, 0) + 1) / total_near) * 1000000) AS BIGINT)) AS s
  FROM (SELECT key, beg, stop, label, unnest(context) AS word FROM ctx WHERE n_labels > 1) o
  JOIN stats ON stats.label = o.label LEFT JOIN near ON near.label = o.label AND near.word = o.word
  GROUP BY o.key, o.beg, o.stop, o.label
),
chosen AS (
  SELECT key, beg, stop, label FROM (
    SELECT c.key, c.beg, c.stop, c.label, row_number() OVER (
             PARTITION BY c.key, c.beg, c.stop ORDER BY prior + coalesce(s, 0) DESC, c.label) AS rn
    FROM ctx c JOIN stats ON stats.label = c.label
    LEFT JOIN sums u ON u.key = c.key AND u.beg = c.beg AND u.stop = c.stop AND u.label = c.label WHERE c.n_labels > 1)
  WHERE rn = 1
  UNION ALL SELECT key, beg, stop, label FROM ctx WHERE n_labels = 1
)"""


@register("label_choice", S.with_ctes(S.WORDS, S.KB, _GAZ_SQL, _SENTS_SQL, _HITS_SQL, _AROUND_SQL, _place_sql("placed", "chosen")) + f"""
SELECT {_MENTION_COLS} FROM placed""")
def q_label_choice(spark, sf_dir):
    """One label per mention; names with several labels are judged by the words around them."""
    toks = N.page_tokens(docs(spark, sf_dir), "doc_id", "text", ws=False, text=True)
    return _mention_columns(N.gazetteer_mentions(toks, gazetteer(spark, _kb(spark, sf_dir)), by_context=AROUND))


# ---------------------------------------------------------------------------
# Relations R1-R6
# ---------------------------------------------------------------------------
_PHRASE_SQL = _POS_SQL + r""",
pe AS (SELECT key, sent, tokens, pos, list_filter(range(0, len(tokens)), lambda i: substr(pos, i + 1, 1) = 'X') AS epos
       FROM pt2),
ph AS (
  SELECT key, sent, tokens, pos, epos,
         unnest(list_filter(range(0, len(tokens)), lambda i: substr(pos, i + 1, 1) = 'V')) AS st FROM pe
),
ph2 AS (SELECT *, length(regexp_extract(substr(pos, st + 1), '^VT?R?[JRNOD]*[TP]?', 0)) AS ln FROM ph),
nr AS (
  SELECT key, sent, CAST(st AS BIGINT) AS start, CAST(ln AS BIGINT) AS len, tokens,
         (list_filter(epos, lambda e: e < st))[-1] AS l, (list_filter(epos, lambda e: e >= st))[1] AS r
  FROM ph2 WHERE len(epos) >= 2
),
rels AS (
  SELECT key, sent, start, len, regexp_replace(tokens[l + 1], '[.,]$', '') AS e1,
         lower(array_to_string(tokens[start + 1 : start + len], ' ')) AS rel,
         regexp_replace(tokens[r + 1], '[.,]$', '') AS e2
  FROM nr WHERE l IS NOT NULL AND r IS NOT NULL
)"""


def _relations(spark, sf_dir):
    return RL.sentence_relations(fx.pos_entities(_pos_sents(spark, sf_dir)))


@register("phrase_spans", "WITH " + _PHRASE_SQL.strip() + """
SELECT key, sent, CAST(st AS BIGINT) AS start, CAST(ln AS BIGINT) AS len,
       array_to_string(tokens[st + 1 : st + ln], ' ') AS phrase FROM ph2""")
def q_phrase_spans(spark, sf_dir):
    """R2: longest verb-phrase match at each verb (POS regex)."""
    s = _pos_sents(spark, sf_dir)
    p = s.select("key", "sent", "tokens", F.explode(RL.phrase_spans(F.col("pos"))).alias("p"))
    return p.select("key", "sent", F.col("p.start").cast("bigint").alias("start"),
                    F.col("p.len").cast("bigint").alias("len"),
                    F.array_join(F.slice("tokens", F.col("p.start") + 1, F.col("p.len")), " ").alias("phrase"))


@register("nearest_entities", "WITH " + _PHRASE_SQL.strip() + """
SELECT key, sent, start, e1, e2 FROM rels""")
def q_nearest_entities(spark, sf_dir):
    """R1 + R3 + F9/F10: nearest entity on each side of each phrase."""
    return _relations(spark, sf_dir).select("key", "sent", "start", "e1", "e2")


@register("relations", "WITH " + _PHRASE_SQL.strip() + """
SELECT key, sent, start, len, e1, rel, e2 FROM rels""")
def q_relations(spark, sf_dir):
    """(e1, lower-cased phrase, e2) triples."""
    return _relations(spark, sf_dir)


_LINKED_REL_SQL = S.with_ctes(*S.LINK_CTES) + "," + _PHRASE_SQL + """,
linked AS (
  SELECT r.key, r.sent, r.start, r.e1, r.e2, a.link AS link1, b.link AS link2, r.rel
  FROM rels r JOIN entities a ON a.key = r.key AND a.mention = r.e1
  JOIN entities b ON b.key = r.key AND b.mention = r.e2
)"""


def _linked_relations(spark, sf_dir):
    """Linked relations and entities; the entities, which several joins read, are written first."""
    ents = stored(q_link_entities(spark, sf_dir), "entities")
    return RL.linked_relations(_relations(spark, sf_dir), ents), ents


@register("linked_relations", _LINKED_REL_SQL + """
SELECT key, sent, start, e1, e2, link1, link2, rel FROM linked""")
def q_linked_relations(spark, sf_dir):
    """R5 + R6: relations whose two ends are linked on the same page."""
    return _linked_relations(spark, sf_dir)[0]


# ---------------------------------------------------------------------------
# Lines and sinks S2-S6
# ---------------------------------------------------------------------------
_ENT_LINE = "'ENTITY: ' || CAST(key AS VARCHAR) || chr(9) || mention || chr(9) || link"
_REL_LINE = "'RELATION: ' || CAST(key AS VARCHAR) || chr(9) || link1 || chr(9) || link2 || chr(9) || rel"


@register("entity_lines", S.with_ctes(*S.LINK_CTES) + f"""
SELECT {_ENT_LINE} AS value FROM entities""")
def q_entity_lines(spark, sf_dir):
    """ENTITY lines."""
    return LN.entity_lines(q_link_entities(spark, sf_dir))


@register("relation_lines", _LINKED_REL_SQL + f"""
SELECT {_REL_LINE} AS value FROM linked""")
def q_relation_lines(spark, sf_dir):
    """RELATION lines."""
    return LN.relation_lines(q_linked_relations(spark, sf_dir))


@register("result_lines", _LINKED_REL_SQL + f"""
SELECT {_ENT_LINE} AS value FROM entities UNION ALL SELECT {_REL_LINE} FROM linked""")
def q_result_lines(spark, sf_dir):
    """Entity and relation lines, ordered per page (entities first)."""
    rels, ents = _linked_relations(spark, sf_dir)
    # the range sort reads its input twice
    return LN.result_lines(ents, stored(rels, "relations"), ordered=True)


def _csv_esc(x: str) -> str:
    return f"regexp_replace(COALESCE({x}, ''), '([\\\\,\"\\r\\n])', '\\\\\\1', 'g')"


_CSV_COLS = ["key", "title", "headers", "text"]


@register("csv_lines", _PAGE_TEXT_SQL.replace("SELECT page_id AS key, title, headers", "SELECT * FROM (SELECT page_id AS key, title, headers", 1)
          .replace("WHERE length(trim(title || ' ' || all_text)) > 0", "WHERE length(trim(title || ' ' || all_text)) > 0) t0")
          .replace("SELECT * FROM (", "SELECT concat_ws(',', " + ", ".join(_csv_esc(f"CAST({c} AS VARCHAR)") for c in _CSV_COLS) + ") AS value FROM (", 1))
def q_csv_lines(spark, sf_dir):
    """Page rows as escaped CSV records (no quoting, backslash escape)."""
    return LN.csv_lines(q_page_text(spark, sf_dir), _CSV_COLS)


@register("csv_roundtrip", _PAGE_TEXT_SQL.replace("SELECT page_id AS key,", "SELECT CAST(page_id AS VARCHAR) AS key,", 1))
def q_csv_roundtrip(spark, sf_dir):
    """S3: escaped CSV records parsed back into the four columns."""
    return LN.parse_csv_lines(q_csv_lines(spark, sf_dir), _CSV_COLS)


# ---------------------------------------------------------------------------
# Scoring E1-E10 (gold derived from predictions and the labels table)
# ---------------------------------------------------------------------------
REPEATED = "http://en.wikipedia.org/wiki/Repeated"


def entity_score_inputs(ents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gold, pred) line tables: gold drops toxic pages, changes links of
    low-quality pages, and repeats the first key with a new value (last wins)."""
    order = F.struct("key", "mention", F.lit(0).alias("seq"))
    pred = ents.select(LN.entity_value().alias("value"), order.alias("line_no"))
    lab = labels.select(F.col("doc_id").alias("key"), "quality", "toxic")
    g = ents.join(lab, "key", "left").where(F.coalesce("toxic", F.lit(0)) == 0).withColumn(
        "link", F.when(F.col("quality") == 0, F.concat("link", F.lit("#changed"))).otherwise(F.col("link")))
    first = ents.groupBy().agg(F.min(F.struct("key", "mention")).alias("f")).select("f.key", "f.mention")
    rep = first.select("key", "mention", F.lit(REPEATED).alias("link"))
    gold = g.select(LN.entity_value().alias("value"), order.alias("line_no")).unionByName(
        rep.select(LN.entity_value().alias("value"), F.struct("key", "mention", F.lit(1).alias("seq")).alias("line_no")))
    return gold, pred


def relation_score_inputs(rels: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    order = F.struct("key", "sent", "start", F.lit(0).alias("seq"))
    pred = rels.select(LN.relation_value().alias("value"), order.alias("line_no"))
    lab = labels.select(F.col("doc_id").alias("key"), "quality", "toxic")
    g = rels.join(lab, "key", "left").where(F.coalesce("toxic", F.lit(0)) == 0)
    swap = F.col("quality") == 0

    def gold_value(s, o):
        return F.concat_ws("\t", F.col("key").cast("string"), F.lit("RELATION"), "rel", s, o,
                           F.concat(F.lit("r"), F.col("start").cast("string")))

    gold = g.select(gold_value(F.when(swap, F.col("link2")).otherwise(F.col("link1")),
                               F.when(swap, F.col("link1")).otherwise(F.col("link2"))).alias("value"),
                    order.alias("line_no"))
    first = rels.groupBy().agg(F.min(F.struct("key", "sent", "start", "rel", "link2")).alias("f")).select("f.*")
    rep = first.select(gold_value(F.lit(REPEATED), F.col("link2")).alias("value"),
                       F.struct("key", "sent", "start", F.lit(1).alias("seq")).alias("line_no"))
    return gold.unionByName(rep), pred


_SCORE_TAIL = """,
joined AS (SELECT g.record AS gr, p.record AS pr, g.v1 AS g1, g.v2 AS g2, p.v1 AS p1, p.v2 AS p2
         FROM g FULL OUTER JOIN p ON g.record = p.record AND g.string = p.string),
cnt AS (SELECT COUNT(gr) AS gold, COUNT(pr) AS predicted,
               COUNT(*) FILTER (WHERE gr IS NOT NULL AND pr IS NOT NULL AND {same}) AS correct FROM joined)
SELECT gold, predicted, correct,
       CASE WHEN predicted = 0 THEN NULL ELSE correct / predicted END AS precision,
       CASE WHEN gold = 0 THEN NULL ELSE correct / gold END AS recall,
       CASE WHEN predicted = 0 OR gold = 0 OR correct = 0 THEN NULL
            ELSE 2 * (correct / predicted) * (correct / gold) / ((correct / predicted) + (correct / gold)) END AS f1
FROM cnt"""

_SCORE_ENTITY_SQL = S.with_ctes(*S.LINK_CTES) + f""",
pred AS (SELECT {_ENT_LINE} AS value, key AS o1, mention AS o2, 0 AS o3 FROM entities),
gsrc AS (
  SELECT e.key, e.mention, CASE WHEN l.quality = 0 THEN e.link || '#changed' ELSE e.link END AS link
  FROM entities e LEFT JOIN labels l ON l.doc_id = e.key WHERE COALESCE(l.toxic, 0) = 0
),
first AS (SELECT key, mention FROM entities ORDER BY key, mention LIMIT 1),
gold AS (
  SELECT {_ENT_LINE} AS value, key AS o1, mention AS o2, 0 AS o3 FROM gsrc
  UNION ALL SELECT 'ENTITY: ' || CAST(key AS VARCHAR) || chr(9) || mention || chr(9) || '{REPEATED}', key, mention, 1
  FROM first
),
gl AS (SELECT {S.py_strip('value')} AS line, o1, o2, o3 FROM gold WHERE contains(value, 'ENTITY')),
g0 AS (SELECT string_split(substr(line, 9), chr(9)) AS f, o1, o2, o3 FROM gl
       WHERE len(string_split(line, chr(9))) = 3),
g AS (SELECT f[1] AS record, f[2] AS string, arg_max(f[3], (o1, o2, o3)) AS v1, NULL AS v2 FROM g0 GROUP BY ALL),
pl AS (SELECT {S.py_strip('value')} AS line, o1, o2, o3 FROM pred WHERE contains(value, 'ENTITY')),
p0 AS (SELECT string_split(substr(line, 9), chr(9)) AS f, o1, o2, o3 FROM pl),
p AS (SELECT f[1] AS record, f[2] AS string, arg_max(f[3], (o1, o2, o3)) AS v1, NULL AS v2 FROM p0
      WHERE len(f) = 3 GROUP BY ALL)""" + _SCORE_TAIL.format(same="g1 = p1")


@register("score_entity", _SCORE_ENTITY_SQL)
def q_score_entity(spark, sf_dir):
    """E1-E10 for entity lines."""
    ents = stored(q_link_entities(spark, sf_dir), "entities")
    gold, pred = entity_score_inputs(ents, fx.read_table(spark, sf_dir, "labels"))
    return E.score(gold, pred, "ENTITY")


_SCORE_REL_SQL = _LINKED_REL_SQL + f""",
pred AS (SELECT {_REL_LINE} AS value, key AS o1, sent AS o2, start AS o3, 0 AS o4 FROM linked),
gsrc AS (
  SELECT r.*, CASE WHEN l.quality = 0 THEN r.link2 ELSE r.link1 END AS s,
         CASE WHEN l.quality = 0 THEN r.link1 ELSE r.link2 END AS o
  FROM linked r LEFT JOIN labels l ON l.doc_id = r.key WHERE COALESCE(l.toxic, 0) = 0
),
first AS (SELECT key, sent, start, rel, link2 FROM linked ORDER BY key, sent, start, rel, link2 LIMIT 1),
gold AS (
  SELECT concat_ws(chr(9), CAST(key AS VARCHAR), 'RELATION', rel, s, o, 'r' || CAST(start AS VARCHAR)) AS value,
         key AS o1, sent AS o2, start AS o3, 0 AS o4 FROM gsrc
  UNION ALL
  SELECT concat_ws(chr(9), CAST(key AS VARCHAR), 'RELATION', rel, '{REPEATED}', link2, 'r' || CAST(start AS VARCHAR)),
         key, sent, start, 1 FROM first
),
gl AS (SELECT {S.py_strip('value')} AS line, o1, o2, o3, o4 FROM gold WHERE contains(value, 'RELATION')),
g0 AS (SELECT string_split(line, chr(9)) AS f, o1, o2, o3, o4 FROM gl),
g AS (SELECT f[1] AS record, f[3] AS string, arg_max(f[4], (o1, o2, o3, o4)) AS v1,
             arg_max(f[5], (o1, o2, o3, o4)) AS v2 FROM g0 WHERE len(f) = 6 GROUP BY ALL),
pl AS (SELECT {S.py_strip('value')} AS line, o1, o2, o3, o4 FROM pred WHERE contains(value, 'RELATION')),
p0 AS (SELECT string_split(substr(line, 11), chr(9)) AS f, o1, o2, o3, o4 FROM pl),
p AS (SELECT f[1] AS record, f[4] AS string, arg_max(f[2], (o1, o2, o3, o4)) AS v1,
             arg_max(f[3], (o1, o2, o3, o4)) AS v2 FROM p0 WHERE len(f) IN (4, 5) GROUP BY ALL)""" + _SCORE_TAIL.format(
    same="g1 = p1 AND g2 = p2")


@register("score_relation", _SCORE_REL_SQL)
def q_score_relation(spark, sf_dir):
    """E1-E10 for relation lines (rel_id ignored)."""
    rels = stored(q_linked_relations(spark, sf_dir), "relations")
    gold, pred = relation_score_inputs(rels, fx.read_table(spark, sf_dir, "labels"))
    return E.score(gold, pred, "RELATION")


# ---------------------------------------------------------------------------
# WARC files (S1): fixture records written as .warc.gz, read back
# ---------------------------------------------------------------------------
from trawl.sources import warc as W  # noqa: E402


def warc_fixture_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the per-page WARC records as gzip WARC files once (checkpoint folder)."""
    import hashlib

    import uuid

    from trawl.session import ensure_checkpoint_dir, path_status, rename_path

    src = f"{sf_dir}/pages.parquet"
    size, mtime = path_status(spark, src)
    tag = hashlib.sha1(f"warc2|{src}|{size}|{mtime}".encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark)}/trawl-warc-{tag}"
    if path_status(spark, f"{path}/_SUCCESS")[0] is None:
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
        recs = fx.warc_payloads(fx.read_table(spark, sf_dir, "pages"))
        W.write_warc(recs.repartition(4), tmp)
        rename_path(spark, tmp, path)  # written once; a concurrent writer's copy wins otherwise
    return path


@register("warc_file_pages", _WARC_SQL)
def q_warc_file_pages(spark, sf_dir):
    """S1 fast path + F1-F4: .warc.gz files split on the marker line by the text source."""
    recs = W.spread(W.read_warc(spark, warc_fixture_files(spark, sf_dir)))
    return html_records(recs, "payload").select("key", "body")


@register("warc_file_exact", _WARC_SQL)
def q_warc_file_exact(spark, sf_dir):
    """S1 exact path (Python data source, one task per file) + F1-F4."""
    recs = W.spread(W.read_warc_exact(spark, warc_fixture_files(spark, sf_dir)))
    return html_records(recs, "payload").select("key", "body")


@register("warc_file_rows", f"""
SELECT 'fixture-' || lpad(CAST(key AS VARCHAR), 8, '0') AS key, title, headers, text FROM ({_PAGE_TEXT_SQL})
WHERE key % 10 NOT IN (3, 7)""")
def q_warc_file_rows(spark, sf_dir):
    """H6: the whole preprocessing job, from .warc.gz files to page rows."""
    from trawl.operators.pages import preprocess_records

    return preprocess_records(W.spread(W.read_warc_exact(spark, warc_fixture_files(spark, sf_dir))), p_mode="autoclose")


# ---------------------------------------------------------------------------
# Streaming: pages arriving as files, linked batch by batch with a link store
# ---------------------------------------------------------------------------
@register("stream_entity_lines")
def q_stream_entity_lines(spark, sf_dir):
    """Structured Streaming over the pages table, one file or a folder of files; equals the batch flagship (rows-only check)."""
    import uuid

    from trawl.session import ensure_checkpoint_dir
    from trawl.streaming.pages_stream import stream_entity_lines

    out = f"{ensure_checkpoint_dir(spark)}/trawl-stream-out-{uuid.uuid4().hex[:12]}"
    return stream_entity_lines(spark, f"{sf_dir}/pages.parquet", _kb(spark, sf_dir), out, files_per_trigger=64)


@register("stream_link_store")
def q_stream_link_store(spark, sf_dir):
    """The same pages arriving as six files, one a batch: later batches meet the link store of the earlier ones."""
    from trawl.session import stage_dir
    from trawl.streaming.pages_stream import stream_entity_lines

    folder = stage_dir(spark, "stream")
    fx.read_table(spark, sf_dir, "pages").repartition(6, "page_id").write.parquet(f"{folder}/pages")
    return stream_entity_lines(spark, f"{folder}/pages", _kb(spark, sf_dir), f"{folder}/out")


# ---------------------------------------------------------------------------
# The flagship chain on pages, with a twin: page text (autoclose) -> tokens,
# sentences -> name n-grams -> candidates -> links
# ---------------------------------------------------------------------------
_PAGE_SENTS_SQL = _SENTS_SQL.replace(
    "tk AS (SELECT doc_id AS key,", "tk AS (SELECT key,").replace("AS wss FROM documents)", "AS wss FROM ptext)")

_PAGE_ENTITIES_SQL = (
    S.with_ctes(S.WORDS, S.KB, _GAZ_SQL, _HTML_CTES)
    + f""",
proc AS (
  SELECT page_id, {S.process_text('title')} AS title,
         {S.process_text(S.join_sentences('list_concat(headers, paras)'))} AS all_text FROM parts
),
ptext AS (SELECT page_id AS key, trim(title || ' ' || all_text) AS text FROM proc
          WHERE length(trim(title || ' ' || all_text)) > 0),
""" + ",".join(p.strip("\n") for p in (_PAGE_SENTS_SQL, _HITS_SQL, longest_sql("found", "key"), _place_sql("mentions", "longest"))) + r""",
""" + ",".join(p.strip("\n") for p in (S.LABEL_CLASS, S.MENTS, S.FORMS, S.BRANCHES)) + """
SELECT key, mention, link FROM entities"""
)


@register("page_entities", _PAGE_ENTITIES_SQL)
def q_page_entities(spark, sf_dir):
    """L7 chain on pages: text -> tokens -> names -> candidates -> links."""
    from trawl.plans.linking import link_pages

    rows = page_rows(pages_as_bodies(pages(spark, sf_dir)), p_mode="autoclose")
    ents, _ = link_pages(spark, rows, _kb(spark, sf_dir), relations=False)
    return ents


# The relations half of the whole job: rule tags, phrases, nearest names with a nominal token, both ends linked.
_PAGE_RELATIONS_SQL = _PAGE_ENTITIES_SQL[: _PAGE_ENTITIES_SQL.rindex("SELECT key, mention, link FROM entities")].rstrip() + r""",
parted AS (
  SELECT key, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS sent, unnest(l) AS s FROM (
    SELECT key, list_transform(starts, lambda b, j: {'toks': toks[b + 1 : coalesce(starts[j + 1], len(toks))],
                                                     'wss': wss[b + 1 : coalesce(starts[j + 1], len(toks))]}) AS l FROM st)
),
tagged AS (
  SELECT key, sent, s.toks AS toks, s.wss AS wss, array_to_string(list_transform(s.toks, lambda tok: CASE
    WHEN regexp_matches(tok, '^[^\pL\pN]+$') THEN 'U' WHEN regexp_matches(tok, '^\pN') THEN 'M'
    WHEN regexp_matches(tok, '^\p{Lu}') THEN 'X' WHEN regexp_matches(tok, 'ly$') THEN 'R'
    WHEN regexp_matches(tok, '(ing|ed|ize|ise)$') THEN 'V'
    WHEN regexp_matches(tok, '(ous|ful|ive|able|ible|al)$') THEN 'J' ELSE 'N' END), '') AS pos FROM parted
),
ends AS (
  SELECT m.key, m.sent, m.start, m.mention FROM mentions m JOIN tagged t ON t.key = m.key AND t.sent = m.sent
  WHERE regexp_matches(substr(t.pos, CAST(m.start + 1 AS BIGINT), CAST(m.stop - m.start AS BIGINT)), '[XNM]')
),
two AS (SELECT key, sent, list({'start': start, 'mention': mention} ORDER BY start) AS e FROM ends GROUP BY key, sent HAVING count(*) >= 2),
verbs AS (
  SELECT t.key, t.sent, t.toks, t.wss, two.e, t.pos, unnest(list_filter(range(0, len(t.toks)), lambda i: substr(t.pos, i + 1, 1) = 'V')) AS v
  FROM tagged t JOIN two ON two.key = t.key AND two.sent = t.sent
),
phrased AS (SELECT *, length(regexp_extract(substr(pos, v + 1), '^VT?R?[JRNOD]*[TP]?', 0)) AS ln FROM verbs),
near_ends AS (
  SELECT key, sent, v, (list_filter(e, lambda x: x.start < v))[-1].mention AS e1, (list_filter(e, lambda x: x.start >= v))[1].mention AS e2,
         lower(array_to_string(list_transform(range(v + 1, v + ln + 1), lambda j: toks[j] || CASE WHEN j < v + ln THEN wss[j] ELSE '' END), '')) AS rel
  FROM phrased
)
SELECT n.key, n.sent, CAST(n.v AS BIGINT) AS start, n.e1, n.e2, a.link AS link1, b.link AS link2, n.rel
FROM near_ends n JOIN entities a ON a.key = n.key AND a.mention = n.e1 JOIN entities b ON b.key = n.key AND b.mention = n.e2"""


@register("page_relations", _PAGE_RELATIONS_SQL)
def q_page_relations(spark, sf_dir):
    """The relations half of the whole job on pages, tags by rule."""
    from trawl.plans.linking import link_pages

    rows = page_rows(pages_as_bodies(pages(spark, sf_dir)), p_mode="autoclose")
    return link_pages(spark, rows, _kb(spark, sf_dir))[1].withColumn("start", F.col("start").cast("bigint"))


# Nested paragraphs in SQL: the page is cut at every '<'; each piece is one
# tag plus the text after it.  A paragraph runs from its <p> to the </p> that
# brings the open-paragraph depth back below it (a walk clamped at zero, as an
# unmatched </p> is ignored), or to the end of an enclosing element
# (</article>, </body>, </html>), or to the end of the page.
_NESTED_SQL = "WITH " + _HTML_CTES.strip() + r""",
pieces AS (
  SELECT page_id, CAST(generate_subscripts(l, 1) AS BIGINT) AS idx, unnest(l) AS piece
  FROM (SELECT page_id, string_split(h, '<') AS l FROM c)
),
ev AS (
  SELECT page_id, idx,
    CASE WHEN idx = 1 THEN piece ELSE regexp_replace(piece, '^[^>]*>', '') END AS txt,
    CASE WHEN idx = 1 THEN NULL
         WHEN regexp_matches(piece, '^p(?:\s[^>]*)?>') THEN 'open'
         WHEN regexp_matches(piece, '^/p\s*>') THEN 'close'
         WHEN regexp_matches(piece, '^/(?:article|body|html)\s*>') THEN 'reset' END AS kind
  FROM pieces
),
seg AS (
  SELECT *, SUM(CASE WHEN kind = 'reset' THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY idx) AS sg,
         CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END AS step
  FROM ev
),
walk AS (SELECT *, SUM(step) OVER (PARTITION BY page_id, sg ORDER BY idx) AS s FROM seg),
walk2 AS (SELECT *, s - LEAST(0, MIN(s) OVER (PARTITION BY page_id, sg ORDER BY idx)) AS depth FROM walk),
opens AS (SELECT page_id, idx, sg, depth FROM walk2 WHERE kind = 'open'),
ends AS (
  SELECT o.page_id, o.idx, COALESCE(
    (SELECT MIN(w.idx) FROM walk2 w WHERE w.page_id = o.page_id AND w.sg = o.sg AND w.idx > o.idx AND w.depth < o.depth),
    (SELECT MIN(w.idx) FROM walk2 w WHERE w.page_id = o.page_id AND w.sg > o.sg),
    (SELECT MAX(w.idx) + 1 FROM walk2 w WHERE w.page_id = o.page_id)) AS stop
  FROM opens o
),
ptext AS (
  SELECT e.page_id, e.idx, string_agg(w.txt, '' ORDER BY w.idx) AS para
  FROM ends e JOIN walk2 w ON w.page_id = e.page_id AND w.idx >= e.idx AND w.idx < e.stop
  GROUP BY e.page_id, e.idx
),
plist AS (SELECT page_id, list(para ORDER BY idx) AS paras FROM ptext GROUP BY page_id),
nparts AS (
  SELECT p.page_id, p.title, p.headers, COALESCE(l.paras, []::VARCHAR[]) AS paras
  FROM parts p LEFT JOIN plist l ON l.page_id = p.page_id
),
proc AS (
  SELECT page_id, """ + S.process_text("title") + """ AS title,
         """ + S.process_text(S.join_sentences("headers")) + """ AS headers,
         """ + S.process_text(S.join_sentences("list_concat(headers, paras)")) + """ AS all_text
  FROM nparts
)
SELECT page_id AS key, title, headers, trim(title || ' ' || all_text) AS text FROM proc
WHERE length(trim(title || ' ' || all_text)) > 0"""

ORACLE["page_text_nested"] = _NESTED_SQL


# The flagship exactly as entry() runs it: nested paragraphs, then the chain.
_NESTED_PAGES_CTES = (_NESTED_SQL[: _NESTED_SQL.index("proc AS (")].rstrip().rstrip(",")
                      .replace("ptext AS (", "partext AS (").replace("FROM ptext GROUP BY", "FROM partext GROUP BY"))
_PAGE_ENTITIES_NESTED_SQL = (
    _NESTED_PAGES_CTES.replace("WITH ", "WITH " + ",".join(p.strip("\n") for p in (S.WORDS, S.KB, _GAZ_SQL)) + ",", 1)
    + f""",
proc AS (
  SELECT page_id, {S.process_text('title')} AS title,
         {S.process_text(S.join_sentences('list_concat(headers, paras)'))} AS all_text FROM nparts
),
ptext AS (SELECT page_id AS key, trim(title || ' ' || all_text) AS text FROM proc
          WHERE length(trim(title || ' ' || all_text)) > 0),
"""
    + _PAGE_ENTITIES_SQL[_PAGE_ENTITIES_SQL.index(_PAGE_SENTS_SQL.strip()[:20]):]
)


@register("page_entities_nested", _PAGE_ENTITIES_NESTED_SQL)
def q_page_entities_nested(spark, sf_dir):
    """The flagship chain with the original paragraph nesting (what entry() returns, as rows)."""
    from trawl.plans.linking import link_pages

    rows = page_rows(pages_as_bodies(pages(spark, sf_dir)), p_mode="nested")
    ents, _ = link_pages(spark, rows, _kb(spark, sf_dir), relations=False)
    return ents

# The stream must write exactly the flagship's entity lines.
assert _PAGE_ENTITIES_NESTED_SQL.rstrip().endswith("SELECT key, mention, link FROM entities")
ORACLE["stream_entity_lines"] = (
    _PAGE_ENTITIES_NESTED_SQL.rstrip()[: -len("SELECT key, mention, link FROM entities")]
    + f"SELECT {_ENT_LINE} AS value FROM entities"
)
ORACLE["stream_link_store"] = ORACLE["stream_entity_lines"]
