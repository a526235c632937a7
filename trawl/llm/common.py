"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import ensure_checkpoint_dir

# Fixed value: a word is a maximal run of characters other than ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column | str) -> Column:
    """All words of a text in order; null text gives an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_RE), F.lit(0))


def word_count(text: Column | str) -> Column:
    """Number of words as a long; null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_RE)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; all other characters stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


BROADCAST_ROWS = 1_000_000  # rows of a few numbers: tens of MB at most


def broadcast_checked(stored: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of narrow rows, with a broadcast hint only if its counted rows are within ``limit``."""
    return F.broadcast(stored) if stored.count() <= limit else stored


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` has it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Scratch:
    """One run's folder under the shared checkpoint folder.

    ``keep`` writes a frame as Parquet and reads it back: lineage is cut at
    files every executor can read, so a lost executor costs a task retry.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{job}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        schema = df.schema
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))
