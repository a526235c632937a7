"""From raw WARC record payloads to HTML page bodies, all native.

A payload is the record text without its ``WARC/1.0`` marker line.  Lines
follow Python ``splitlines``.  ``layout="fixed"`` reproduces the original
fixed positions (key line at index 2, HTTP headers from index 10);
``layout="rfc"`` finds the key by name and the HTTP headers after the first
blank line, for archives whose WARC headers are not in that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trawl.functions.plan import compute_once
from trawl.functions.text import split_lines


def record_key(lines: Column, layout: str = "fixed") -> Column:
    """text between the first and second ``': '`` of the key line."""
    if layout == "fixed":
        line = F.get(lines, 2)
        return F.when(line.startswith("WARC-TREC-ID"), F.get(F.split(line, ": ", -1), 1))
    line = F.get(F.filter(lines, lambda x: x.startswith("WARC-TREC-ID")), 0)
    return F.get(F.split(line, ": ", -1), 1)


def _http_part(lines: Column, layout: str) -> Column:
    if layout == "fixed":
        return F.slice(lines, 11, F.greatest(F.size(lines) - 10, F.lit(0)))
    first_blank = F.array_position(lines, "")
    return F.when(first_blank > 0, F.slice(lines, (first_blank + 1).cast("int"), F.size(lines))).otherwise(
        F.array().cast("array<string>")
    )


def html_body(lines: Column, layout: str = "fixed") -> tuple[Column, Column]:
    """F2 + F3: (is_html, body lines after the first blank header line)."""
    h = _http_part(lines, layout)
    blank = F.array_position(h, "").cast("int")
    head = F.when(blank > 0, F.slice(h, 1, blank)).otherwise(h)
    is_html = F.exists(head, lambda x: F.lower(x).startswith("content-type") & F.lower(x).contains("html"))
    body = F.when(blank > 0, F.slice(h, blank + 1, F.greatest(F.size(h) - blank, F.lit(0)))).otherwise(
        F.array().cast("array<string>")
    )
    return is_html, body


def html_records(records: DataFrame, payload_col: str = "payload", layout: str = "fixed",
                 keep: list[str] | None = None, watch: Observation | None = None) -> DataFrame:
    """Keep HTML responses with a key; ``body`` is the joined HTTP body.

    The body lines are joined with one space (as the original does before
    unescaping).  Rejected records (empty payload, no key, not HTML) are
    dropped here, before any parsing; ``watch`` counts them by reason in the
    same pass.
    """
    keep = keep or []
    staged = compute_once(records, keep=[*keep, payload_col], _lines=split_lines(F.col(payload_col)))
    is_html, body = html_body(F.col("_lines"), layout)
    staged = compute_once(
        staged, keep=keep,
        key=record_key(F.col("_lines"), layout),
        _is_html=is_html,
        _nonempty=F.length(payload_col) > 0,
        _body=body,
    )
    if watch is not None:
        keyed = F.col("_nonempty") & F.col("key").isNotNull()
        staged = staged.observe(
            watch, F.count(F.lit(1)).alias("records"), F.count_if(~F.col("_nonempty")).alias("empty"),
            F.count_if(F.col("_nonempty") & F.col("key").isNull()).alias("no_key"),
            F.count_if(keyed & ~F.col("_is_html")).alias("not_html"))
    kept = staged.where(F.col("_nonempty") & F.col("key").isNotNull() & F.col("_is_html"))
    return kept.select(*keep, "key", F.array_join("_body", " ").alias("body"))


def rejected_records(records: DataFrame, payload_col: str = "payload", layout: str = "fixed") -> DataFrame:
    """Q4: the records F1-F4 drop, with the reason (the original would stop)."""
    lines = split_lines(F.col(payload_col))
    is_html, _ = html_body(lines, layout)
    key = record_key(lines, layout)
    reason = (
        F.when(F.length(payload_col) == 0, "empty")
        .when(key.isNull(), "no_key")
        .when(~is_html, "not_html")
    )
    return records.select("*", reason.alias("reason")).where(F.col("reason").isNotNull())
