"""SQL text of the derived fixtures and text rules, for the DuckDB twins.

These strings mirror the Spark expressions of ``trawl.functions`` and
``trawl.plans.fixtures`` one for one; RE2 syntax (``\\1`` back-references,
``$`` = end of text without the multi-line flag).
"""

from __future__ import annotations

from trawl.operators.annotate import TOKEN_WS_RE as TOKEN_WS

R = "http://dbpedia.org/resource/"
WIKI = "http://en.wikipedia.org/wiki/"

PY_SPACE = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def valid(w: str) -> str:
    return (f"(length({w}) > 0 AND regexp_matches({w}, '^[a-zA-Z\\p{{Nd}}$€:.,-]') "
            f"AND (length({w}) > 1 OR regexp_matches({w}, '^[a-zA-Z\\p{{Nd}}]')))")


def sanitize(w: str) -> str:
    return (f"CASE WHEN {w} LIKE '%.' THEN regexp_replace({w}, '[^\\pL\\pN]\\.$', '.') "
            f"ELSE regexp_replace({w}, '[^\\pL\\pN]$', '') END")


def kept_words(t: str) -> str:
    return (f"array_to_string(list_transform(list_filter(string_split({t}, ' '), lambda w: {valid('w')}), "
            f"lambda w: {sanitize('w')}), ' ')")


def marks(s: str) -> str:
    m = f"regexp_replace({s}, '([?!])( |$)', '\\1.\\2', 'g')"
    return f"CASE WHEN {s} = '' THEN '' WHEN {m} LIKE '%.' THEN {m} ELSE {m} || '.' END"


def process_text(t: str) -> str:
    """T4 as one expression."""
    return marks(f"({kept_words(t)})")


def join_sentences(a: str) -> str:
    return f"array_to_string(list_transform({a}, lambda s: CASE WHEN s LIKE '%.' THEN s ELSE s || '.' END), ' ')"


def collapse_ws(s: str) -> str:
    return f"trim(regexp_replace({s}, '[{PY_SPACE}]+', ' ', 'g'))"


def py_strip(s: str) -> str:
    return f"regexp_replace({s}, '^[{PY_SPACE}]+|[{PY_SPACE}]+$', '', 'g')"


SMALL = ("'a','an','and','as','at','but','by','en','for','if','in','of','on','or','the','to',"
         "'v','v.','via','vs','vs.'")


def title_case(s: str) -> str:
    """T8, same pinned rules as the Spark expression."""
    caps = f"({s} = upper({s}))"
    base = f"(CASE WHEN {caps} THEN lower(w) ELSE w END)"
    lead = f"regexp_extract({base}, '^([^\\pL\\pN]*)', 1)"
    rest = f"substr({base}, length({lead}) + 1)"
    # Java and Python upper-case a leading sharp s to "SS" (DuckDB: U+1E9E)
    capped = f"({lead} || replace(upper(substr({rest}, 1, 1)), 'ẞ', 'SS') || substr({rest}, 2))"
    n = f"len(string_split({s}, ' '))"
    one = (f"CASE WHEN regexp_matches(w, '^[^\\pL\\pN]*\\pL+\\p{{Lu}}') AND NOT {caps} THEN w "
           f"WHEN list_contains([{SMALL}], lower(w)) AND i > 1 AND i < {n} THEN lower(w) "
           f"ELSE {capped} END")
    return f"array_to_string(list_transform(string_split({s}, ' '), lambda w, i: {one}), ' ')"


def mention_key(s: str) -> str:
    return f"lower({collapse_ws(s)})"


def m0(s: str) -> str:
    return collapse_ws(f"regexp_replace({py_strip(s)}, '^[''\"]+|[''\"]+$', '', 'g')")


# Derived fixture CTEs -------------------------------------------------------
WORDS = r"""
words AS (
  SELECT key, pos, regexp_replace(tok, '[.,]$', '') AS word FROM (
    SELECT doc_id AS key, unnest(l) AS tok, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos
    FROM (SELECT doc_id, string_split_regex(text, '[ \n]+') AS l FROM documents))
  WHERE regexp_matches(tok, '^\p{Lu}\p{Ll}{3,}[.,]?$')
)"""

MENTIONS = r"""
mentions AS (
  SELECT key, pos, word AS mention,
         (['PERSON','GPE','PRODUCT','CARDINAL'])[length(word) % 4 + 1] AS label
  FROM words
)"""

LABEL_CLASS = """
label_class AS (
  SELECT * FROM (VALUES ('PERSON','dbo:Person'), ('GPE','geo:SpatialThing'), ('LOC','geo:SpatialThing'),
    ('FAC','geo:SpatialThing'), ('LANGUAGE','dbo:Language'), ('ORG','dbo:Organisation'),
    ('PRODUCT','owl:Thing'), ('EVENT','dbo:Event'), ('DATE','owl:Thing'), ('NORP','owl:Thing'),
    ('WORK_OF_ART','dbo:Work')) AS t(label, class)
)"""

# Tokens and the white space after each (annotate.TOKEN_WS_RE); one blank for any white space inside a cut-out text.
TOKEN_WS_RE = TOKEN_WS.replace("'", "''")


def spaced(tokens: str, ws: str, first: str, last: str) -> str:
    """Tokens ``first`` to ``last`` (1-based) as written, white space between them as one blank."""
    return (f"array_to_string(list_transform(range({first}, {last} + 1), lambda j: {tokens}[j] || "
            f"CASE WHEN j < {last} AND {ws}[j] <> '' THEN ' ' ELSE '' END), '')")


# Edit distance counts code points; DuckDB's counts bytes, so letters beyond ASCII become one control character each.
LETTERS = "ÄÖÜßäöüÀÂÆÇÈÉÊËÎÏÔŒÙÛŸàâæçèéêëîïôœùûÿÁÍÓÚÑáíóúñ"


def distance(a: str, b: str) -> str:
    codes = "".join(f"chr({i})" + " || " for i in (*range(1, 32), *range(35, 200)) if i not in (9, 10, 13) and (i < 32 or chr(i) in "#$%&*+;<=>@[]^_`{|}~"))
    codes = codes.split(" || ")[: len(LETTERS)]
    to = " || ".join(codes)
    return f"levenshtein(translate({a}, '{LETTERS}', {to}), translate({b}, '{LETTERS}', {to}))"


KB = f"""
titles AS (
  SELECT key, {spaced('toks', 'wss', '1', 'least(len(toks), 2 + key % 5)')} AS name
  FROM (SELECT doc_id AS key, regexp_extract_all(text, '{TOKEN_WS_RE}', 1) AS toks,
               regexp_extract_all(text, '{TOKEN_WS_RE}', 2) AS wss FROM documents)
  WHERE len(toks) >= 2
),
named AS (SELECT DISTINCT 'title_' || md5(name) AS id, name FROM titles),
items AS (SELECT DISTINCT word FROM words WHERE length(word) >= 5),
kb_label AS (
  SELECT '{R}' || word AS item, word AS name, 'en' AS lang FROM items
  UNION ALL SELECT '{R}' || word, lower(word), 'fr' FROM items
  UNION ALL SELECT '{R}' || id, name, 'en' FROM named
),
kb_type AS (
  SELECT '{R}' || word AS item,
         (['dbo:Person','geo:SpatialThing','owl:Thing'])[length(word) % 3 + 1] AS class FROM items
  UNION ALL SELECT '{R}' || word, (['dbo:Person','geo:SpatialThing','owl:Thing'])[(length(word) + 1) % 3 + 1]
  FROM items WHERE length(word) % 4 = 1
  UNION ALL SELECT '{R}' || id, 'dbo:Work' FROM named
  UNION ALL SELECT '{R}' || id, 'dbo:Event' FROM named WHERE length(name) % 2 = 0
),
kb_topic AS (
  SELECT '{R}' || word AS item, '{WIKI}' || word AS page FROM items
  UNION ALL SELECT '{R}' || id, '{WIKI}' || id FROM named
),
kb_link AS (
  SELECT DISTINCT source, target FROM (
    SELECT '{R}doc_' || CAST(key AS VARCHAR) AS source, '{R}' || word AS target FROM words WHERE length(word) >= 5
    UNION ALL SELECT '{R}doc_' || CAST(key AS VARCHAR), '{R}title_' || md5(name) FROM titles)
),
kb_disambig AS (
  SELECT '{R}' || substr(word, 1, 4) || '_(disambiguation)' AS page, '{R}' || word AS item FROM items
  UNION ALL SELECT '{R}' || substr(word, 1, 4), '{R}' || word FROM items WHERE length(word) % 2 = 0
),
kb_redirect AS (
  SELECT '{R}' || a.word AS src, '{R}' || b.word AS dst
  FROM items a JOIN items b ON b.word = substr(a.word, 1, length(a.word) - 2)
  WHERE length(a.word) >= 7
),
in_degree AS (SELECT target AS item, COUNT(*) AS in_degree FROM kb_link GROUP BY target),
item_cards AS (
  SELECT t.item, t.class, d.in_degree, p.page, l.name
  FROM (SELECT DISTINCT item, class FROM kb_type) t
  JOIN in_degree d ON d.item = t.item
  JOIN kb_topic p ON p.item = t.item
  JOIN kb_label l ON l.item = t.item AND (lower(l.lang) = 'en' OR lower(l.lang) LIKE 'en-%')
)"""

MENTS = f"""
ments AS (
  SELECT DISTINCT m.key, m.mention, m.label, c.class, {mention_key('m.mention')} AS mention_key
  FROM mentions m JOIN label_class c ON c.label = m.label
),
reps AS (SELECT mention_key, class, min(mention) AS rep FROM ments GROUP BY mention_key, class)"""

FORMS = f"""
forms0 AS (
  SELECT mention_key, class, rep, {m0('rep')} AS m0 FROM reps
),
forms1 AS (SELECT *, {title_case('m0')} AS m2 FROM forms0),
forms AS (
  SELECT DISTINCT mention_key, class, rep, label_form, page_form FROM (
    SELECT mention_key, class, rep, m2 AS label_form, replace(m2, ' ', '_') AS page_form FROM forms1
    UNION ALL
    SELECT mention_key, class, rep, m0, replace(m0, ' ', '_') FROM forms1)
)"""

BRANCHES = f"""
hits AS (
  SELECT f.mention_key, f.class, f.rep, l.item AS temp
  FROM forms f JOIN kb_label l ON l.name = f.label_form AND l.lang = 'en'
),
branches AS (
  SELECT mention_key, class, rep, temp AS item, 'label' AS branch FROM hits
  UNION ALL SELECT mention_key, class, rep, temp, 'redirect' FROM hits
  UNION ALL SELECT h.mention_key, h.class, h.rep, r.dst, 'redirect'
            FROM hits h JOIN kb_redirect r ON r.src = h.temp WHERE r.dst <> h.temp
  UNION ALL SELECT f.mention_key, f.class, f.rep, d.item, 'disambig_page'
            FROM forms f JOIN kb_disambig d ON d.page = '{R}' || f.page_form || '_(disambiguation)'
  UNION ALL SELECT f.mention_key, f.class, f.rep, d.item, 'disambig_self'
            FROM forms f JOIN kb_disambig d ON d.page = '{R}' || f.page_form
),
mult AS (SELECT mention_key, class, rep, item, COUNT(*) AS mult FROM branches GROUP BY ALL),
cands AS (
  SELECT m.mention_key, m.class, m.rep, m.item, c.name, c.page, m.mult * c.in_degree AS cnt
  FROM mult m JOIN item_cards c ON c.item = m.item AND c.class = m.class
),
best AS (
  SELECT mention_key, class, rep, page AS link FROM (
    SELECT *, row_number() OVER (PARTITION BY mention_key, class, rep
                                 ORDER BY cnt DESC, {distance('rep', 'name')}, page) AS rn FROM cands)
  WHERE rn = 1
),
resolved AS (
  SELECT r.mention_key, r.class, r.rep, b.link FROM reps r
  LEFT JOIN best b ON b.mention_key = r.mention_key AND b.class = r.class AND b.rep = r.rep
),
entities AS (
  SELECT key, mention, arg_min(link, label) AS link FROM (
    SELECT m.key, m.mention, m.label, r.link FROM ments m
    JOIN resolved r ON r.mention_key = m.mention_key AND r.class = m.class WHERE r.link IS NOT NULL)
  GROUP BY key, mention
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


LINK_CTES = (WORDS, MENTIONS, LABEL_CLASS, KB, MENTS, FORMS, BRANCHES)
