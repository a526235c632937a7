"""Page rows ``(key, title, headers, text)`` from HTML bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.html import extract_html
from trawl.functions.plan import compute_once
from trawl.functions.text import join_sentences, process_text, split_lines
from trawl.operators.records import html_records


def page_rows(bodies: DataFrame, key_col: str = "key", body_col: str = "body", p_mode: str = "nested",
              strict_words: bool = False) -> DataFrame:
    """H1-H5 + F5 over ``(key, body)``; returns ``(key, title, headers, text)``.

    * H2-H4: one Arrow step emits title, header texts, paragraph texts;
    * headers = T4(T1(header texts)); all text = T1(headers ++ paragraphs);
    * text = strip(T4(title) + ' ' + T4(all text)); rows with empty text go (F5).
    """
    parts = extract_html(bodies, key_col, body_col, p_mode)
    title = process_text(F.col("title"), strict_words)
    headers = process_text(join_sentences(F.col("headers")), strict_words)
    all_text = process_text(join_sentences(F.concat(F.col("headers"), F.col("paras"))), strict_words)
    staged = compute_once(parts, keep=[key_col], title=title, headers=headers, all_text=all_text)
    rows = compute_once(staged, keep=[key_col, "title", "headers"],
                        text=F.trim(F.concat("title", F.lit(" "), "all_text")))
    return rows.where(F.col(key_col).isNotNull() & (F.length("text") > 0)).select(
        F.col(key_col).alias("key"), "title", "headers", "text")


def pages_as_bodies(pages: DataFrame, key_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A pages table seen as HTTP bodies: lines joined by one space, as F3 does."""
    return pages.select(F.col(key_col).alias("key"), F.array_join(split_lines(F.col(html_col)), " ").alias("body"))


def preprocess_records(records: DataFrame, payload_col: str = "payload", layout: str = "fixed",
                       p_mode: str = "nested") -> DataFrame:
    """H6: the whole preprocessing job from WARC payloads to page rows."""
    return page_rows(html_records(records, payload_col, layout), p_mode=p_mode)
