"""Line formats and text sinks/sources.

* S6 entity / relation lines (``ENTITY: key<TAB>mention<TAB>link``);
* S4 result sink (optionally ordered per page: entities, then relations);
* S2/S3 escaped CSV (no quoting, backslash escape, CRLF), built and parsed
  with native string functions: Spark's CSV writer cannot produce this
  format (an empty quote character writes NUL bytes and leaves commas
  unescaped);
* S8 ordered line scan (last-line-wins needs the line order);
* S10 relation sample files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def entity_value() -> F.Column:
    return F.concat(F.lit("ENTITY: "), F.col("key").cast("string"), F.lit("\t"), "mention", F.lit("\t"), "link")


def relation_value() -> F.Column:
    return F.concat(F.lit("RELATION: "), F.col("key").cast("string"), F.lit("\t"), "link1", F.lit("\t"), "link2",
                    F.lit("\t"), "rel")


def entity_lines(entities: DataFrame) -> DataFrame:
    """``ENTITY: key\\tmention\\tlink``."""
    return entities.select(entity_value().alias("value"))


def relation_lines(relations: DataFrame) -> DataFrame:
    """``RELATION: key\\tlink1\\tlink2\\tphrase``."""
    return relations.select(relation_value().alias("value"))


def result_lines(entities: DataFrame, relations: DataFrame, ordered: bool = False,
                 page_order: DataFrame | None = None, places: DataFrame | None = None) -> DataFrame:
    """All output lines; ``ordered`` sorts per page, entities first.

    ``page_order`` (key, page_no), ``page_no`` of any sortable type, gives the
    order of the pages; without it they go by key.  ``places`` (key, mention, sent,
    start) orders the entities of a page by their first mention; without it they
    go by text.  The global sort is opt-in: it is a range shuffle of the whole output.
    """
    e = entities.select("key", F.lit(0).alias("kind"), "mention", F.lit(0).cast("bigint").alias("sent"),
                        F.lit(0).cast("bigint").alias("start"), entity_value().alias("value"))
    if ordered and places is not None:
        first = places.groupBy("key", "mention").agg(F.min(F.struct(
            F.col("sent").cast("bigint").alias("sent"), F.col("start").cast("bigint").alias("start"))).alias("p"))
        e = e.drop("sent", "start").join(first, ["key", "mention"], "left").select(
            "key", "kind", "mention", "p.sent", "p.start", "value")
    r = relations.select("key", F.lit(1).alias("kind"), F.lit("").alias("mention"), F.col("sent").cast("bigint").alias("sent"),
                         F.col("start").cast("bigint").alias("start"), relation_value().alias("value"))
    out = e.unionByName(r)
    if not ordered:
        return out.select("value")
    if page_order is not None:
        out = out.join(page_order.select("key", "page_no"), "key", "left")
        return out.orderBy("page_no", "key", "kind", "sent", "start", "mention", "value").select("value")
    return out.orderBy("key", "kind", "sent", "start", "mention", "value").select("value")


def write_lines(lines: DataFrame, path: str, line_sep: str = "\n") -> None:
    """UTF-8 text output, overwrite."""
    lines.select("value").write.mode("overwrite").option("lineSep", line_sep).text(path)


# S2 / S3 -------------------------------------------------------------------
def csv_escape(col) -> F.Column:
    """One field, QUOTE_NONE with ``\\`` as escape: ``\\ , " CR LF`` get a backslash."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r'([\\,"\r\n])', r"\\$1")


def csv_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """``value`` = the escaped CSV record (without the CRLF terminator)."""
    return df.select(F.concat_ws(",", *[csv_escape(c) for c in cols]).alias("value"))


def write_csv(df: DataFrame, cols: list[str], path: str) -> None:
    """Write with CRLF row ends, no header, UTF-8."""
    write_lines(csv_lines(df, cols), path, "\r\n")


def parse_csv_lines(lines: DataFrame, names: list[str]) -> DataFrame:
    """S3: escaped CSV records (``value``) back to columns."""
    n = len(names)
    fields = F.slice(F.regexp_extract_all("value", F.lit(r"(?s)((?:[^\\,]++|\\.)*+)(?:,|\z)"), 1), 1, n)
    return lines.select(*[F.regexp_replace(F.get(fields, i), r"(?s)\\(.)", "$1").alias(nm)
                          for i, nm in enumerate(names)])


def read_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """S3: a record may span lines (escaped newline); records end at CRLF."""
    return parse_csv_lines(spark.read.option("lineSep", "\r\n").text(path), names)


# S8 / S10 -------------------------------------------------------------------
def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, line_no) with ``line_no`` ordering lines as in the files.

    ``line_no`` is a struct (file path, split start, row id): Spark packs
    splits into tasks by size, not by file order, so a row id alone orders
    lines only within a split; within a split it increases with the line.
    """
    order = F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select("value", order.alias("line_no"))


def parse_relation_lines(lines: DataFrame) -> DataFrame:
    """``RELATION: key<TAB>link1<TAB>link2<TAB>phrase`` -> columns."""
    parts = F.split(F.substring("value", 11, 1 << 30), "\t", -1)
    return lines.where(F.col("value").startswith("RELATION: ") & (F.size(parts) == 4)).select(
        parts[0].alias("key"), parts[1].alias("link1"), parts[2].alias("link2"), parts[3].alias("rel"))


def parse_entity_lines(lines: DataFrame) -> DataFrame:
    parts = F.split(F.substring("value", 9, 1 << 30), "\t", -1)
    return lines.where(F.col("value").startswith("ENTITY: ") & (F.size(parts) == 3)).select(
        parts[0].alias("key"), parts[1].alias("mention"), parts[2].alias("link"))
