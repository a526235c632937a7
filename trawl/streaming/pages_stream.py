"""Incremental linking with Structured Streaming.

New page files (parquet ``page_id, url, html``) arrive in a folder; each
micro-batch runs page text -> mentions -> links -> entity lines.  The link
store (L5's cache of resolved mentions, misses included, ``link_store``) persists across
batches, so a mention is resolved against the graph once, in the batch
where it first appears; later batches read the buckets of their own keys.

Failure model: the stream checkpoint records which files each epoch read;
every epoch writes its outputs into its own ``epoch=<id>`` folder with
overwrite, so an epoch replayed after a failure rewrites the same folders
(idempotent), and a replay reads the store without its own epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators import annotate as N
from trawl.operators.link import HOT_ROWS, distinct_mentions, join_links, label_class_table, resolve_mentions
from trawl.operators.names import NameIndex, name_index
from trawl.operators.pages import page_rows, pages_as_bodies
from trawl.session import is_folder
from trawl.sources.kb import KnowledgeGraph
from trawl.sources.lines import entity_value
from trawl.streaming.link_store import KEYS, LinkStore

PAGES_SCHEMA = "page_id bigint, url string, html string"


def link_batch(df: DataFrame, epoch_id: int, kb: KnowledgeGraph, out_dir: str,
               p_mode: str = "nested", names: NameIndex | None = None) -> None:
    """One micro-batch: page rows -> gazetteer mentions -> store-aware linking -> lines.

    ``names`` is the index of the graph's names, built here if it is not given.  A batch of
    few files is spread over all cores first.
    """
    from trawl.plans.linking import gazetteer, materialise

    spark = df.sparkSession
    names = names or name_index(gazetteer(spark, kb))
    rows = page_rows(pages_as_bodies(df.repartition(spark.sparkContext.defaultParallelism)), p_mode=p_mode)
    folder = f"{out_dir}/stages/epoch={epoch_id}"  # written, so a lost executor does not parse the pages again
    toks = materialise(N.page_tokens(rows, "key", "text"), folder, "page_tokens")
    ments = distinct_mentions(
        N.longest_mentions(N.gazetteer_mentions(toks, names)), label_class_table(spark))
    ments = materialise(ments, folder, "mentions")
    store = LinkStore(spark, f"{out_dir}/link_store")
    reps = ments.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    known = materialise(store.lookup(reps, epoch_id), folder, "known")
    fresh = store.append(resolve_mentions(ments, kb, known=known), epoch_id)
    answers = known.unionByName(fresh).join(reps, KEYS)
    linked = join_links(ments, answers, KEYS, HOT_ROWS).where(F.col("link").isNotNull())
    ents = linked.groupBy("key", "mention").agg(F.min_by("link", "label").alias("link"))
    ents.select(entity_value().alias("value")).write.mode("overwrite").text(f"{out_dir}/lines/epoch={epoch_id}")


def start_page_stream(spark: SparkSession, pages_dir: str, kb: KnowledgeGraph, out_dir: str,
                      checkpoint: str | None = None, files_per_trigger: int = 1, available_now: bool = True,
                      file_glob: str = "*.parquet"):
    """Start the stream over the files of ``pages_dir`` (a folder or one file) matching ``file_glob``.

    The names of the graph are indexed once, before the first batch.
    """
    from trawl.plans.linking import gazetteer

    if not is_folder(spark, pages_dir):  # a stream reads a folder: the one that holds the file
        pages_dir, file_glob = pages_dir.rsplit("/", 1)
    names = name_index(gazetteer(spark, kb))
    ckpt = checkpoint or f"{out_dir}/_stream_checkpoint"
    src = (spark.readStream.schema(PAGES_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
           .option("pathGlobFilter", file_glob).parquet(pages_dir))
    writer = (src.writeStream.foreachBatch(lambda df, eid: link_batch(df, eid, kb, out_dir, names=names))
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def stream_entity_lines(spark: SparkSession, pages_dir: str, kb: KnowledgeGraph, out_dir: str,
                        file_glob: str = "*.parquet", files_per_trigger: int = 1) -> DataFrame:
    """Run the stream over what is there now, then read all written lines."""
    q = start_page_stream(spark, pages_dir, kb, out_dir, files_per_trigger=files_per_trigger, file_glob=file_glob)
    q.awaitTermination()
    return spark.read.text(f"{out_dir}/lines").select("value")
