"""Command line jobs (U5), for ``spark-submit`` or ``python -m trawl.plans.run``.

    preprocess  WARC files -> page rows (parquet, or escaped CSV with --csv)
    link        WARC files or a pages table -> entity and relation lines
    score       GOLD PRED TYPE -> gold, predicted, correct, precision, recall, f1
    graph       N-Triples dumps -> the folder that ``link --kb`` reads
    lexicon     a table of tagged words -> the folder that ``link --lexicon`` reads

What a job leaves out is counted and printed: records that are no pages,
score lines and triples of the wrong form.

Options are plain arguments; a missing output name defaults to
``warcs-YYYYmmdd-HHMMSS`` (S7).  The session comes from ``spark-submit``
(master, checkpoint folder); run locally, a local session is created.
"""

from __future__ import annotations

import argparse
import datetime
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def default_output_name(now: datetime.datetime | None = None) -> str:
    """Name from the clock."""
    return f"warcs-{(now or datetime.datetime.now()).strftime('%Y%m%d-%H%M%S')}"


def _session() -> SparkSession:
    """The submitted session (master and checkpoint folder from its config)."""
    from trawl.session import ensure_checkpoint_dir, ship_package

    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("trawl").getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def warc_pages(spark: SparkSession, path: str, fast: bool = False, layout: str = "fixed",
               p_mode: str = "nested", watch: Observation | None = None) -> DataFrame:
    """S1 -> F1-F5 -> H: page rows of WARC files.

    Files are read exactly unless ``fast`` is asked for (CRLF files only).
    Records that are no pages go before the rest is spread over the cluster.
    """
    from trawl.operators.pages import page_rows
    from trawl.operators.records import html_records
    from trawl.sources import warc as W

    recs = W.read_warc(spark, path) if fast else W.read_warc_exact(spark, path)
    bodies = W.spread(html_records(recs, "payload", layout, ["file", "rec_no"], watch))
    return page_rows(bodies.select("key", "body"), p_mode=p_mode)


def warc_order(spark: SparkSession, path: str, fast: bool = False, layout: str = "fixed") -> DataFrame:
    """(key, page_no): where each page stands in the WARC files; a key that repeats takes its first place."""
    from trawl.operators.records import html_records
    from trawl.sources import warc as W

    recs = W.read_warc(spark, path) if fast else W.read_warc_exact(spark, path)
    return html_records(recs, "payload", layout, ["file", "rec_no"]).groupBy("key").agg(
        F.min(F.struct("file", "rec_no")).alias("page_no"))


def _print_rejects(watch: Observation) -> None:
    counts = watch.get
    print("rejected records: " + ", ".join(f"{k} {counts[k]}" for k in ("empty", "no_key", "not_html"))
          + f" of {counts['records']}")


def cmd_preprocess(a) -> None:
    from trawl.sources.lines import write_csv

    spark = _session()
    watch = Observation("records")
    rows = warc_pages(spark, a.warc, a.fast, a.layout, a.p_mode, watch)
    name = a.name or default_output_name()
    out = f"{a.pre_proc_dir}/{name}"
    if a.csv:
        write_csv(rows, ["key", "title", "headers", "text"], out + ".csv")
    else:
        rows.write.mode("overwrite").parquet(out)
    _print_rejects(watch)
    print(out)


def cmd_link(a) -> None:
    from trawl.operators.pages import page_rows, pages_as_bodies
    from trawl.plans.linking import link_pages, materialise, run_stage_dir
    from trawl.sources.kb import KnowledgeGraph
    from trawl.sources.lines import result_lines, write_lines

    spark = _session()
    stage = a.stage_dir or run_stage_dir(spark)
    watch = Observation("records")
    if a.warc:
        rows = warc_pages(spark, a.warc, a.fast, a.layout, a.p_mode, watch)
    elif a.pre_proc:
        rows = spark.read.parquet(a.pre_proc)
    else:
        rows = page_rows(pages_as_bodies(spark.read.parquet(a.pages)), p_mode=a.p_mode)
    rows = materialise(rows, stage, "page_text")
    if a.warc:
        _print_rejects(watch)
    kb = KnowledgeGraph.load(spark, a.kb)
    lexicon = spark.read.parquet(a.lexicon) if a.lexicon else None
    ents, rels = link_pages(spark, rows, kb, lexicon, stage)
    order = places = None
    if a.ordered:
        order = warc_order(spark, a.warc, a.fast, a.layout) if a.warc else None
        places = spark.read.parquet(f"{stage}/mentions")
    lines = result_lines(ents, rels, a.ordered, order, places)
    write_lines(lines, a.out)
    if a.show:  # S5
        spark.read.text(a.out).show(a.show, truncate=False)


def cmd_score(a) -> None:
    from trawl.operators.score import score, skipped
    from trawl.sources.lines import read_ordered_lines

    spark = _session()
    gold, pred = read_ordered_lines(spark, a.gold), read_ordered_lines(spark, a.pred)
    r = score(gold, pred, a.type, a.strict).first()
    for role, lines in (("gold", gold), ("pred", pred)):
        print(f"skipped {role} lines: {skipped(lines, a.type, role, a.strict).count()}")
    print(f"Evaluation {'ENTITY LINKING' if a.type == 'ENTITY' else 'RELATION EXTRACTION'}")
    for k in ("gold", "predicted", "correct", "precision", "recall", "f1"):
        print(f"{k}: {r[k]}")


def cmd_graph(a) -> None:
    from trawl.plans.linking import run_stage_dir
    from trawl.sources.kb import read_ntriples, rejected_lines

    spark = _session()
    read_ntriples(spark, a.dumps, run_stage_dir(spark) + "/triples").save(a.out)
    print(f"rejected lines: {rejected_lines(spark.read.text(a.dumps)).count()}")
    print(a.out)


def cmd_lexicon(a) -> None:
    from trawl.operators.annotate import pos_lexicon

    spark = _session()
    pos_lexicon(spark.read.parquet(a.tagged), a.word, a.tag).write.mode("overwrite").parquet(a.out)
    print(a.out)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="trawl")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--fast", action="store_true", help="text source for WARC files with CRLF marker lines")
        sp.add_argument("--layout", default="fixed", choices=["fixed", "rfc"])
        sp.add_argument("--p-mode", default="nested", choices=["nested", "autoclose"])

    pp = sub.add_parser("preprocess")
    pp.add_argument("--warc", required=True)
    pp.add_argument("--pre-proc-dir", default="pre-proc")
    pp.add_argument("--name", default=None)
    pp.add_argument("--csv", action="store_true")
    common(pp)
    pp.set_defaults(fn=cmd_preprocess)

    pl = sub.add_parser("link")
    src = pl.add_mutually_exclusive_group(required=True)
    src.add_argument("--warc")
    src.add_argument("--pages")
    src.add_argument("--pre-proc")
    pl.add_argument("--kb", required=True, help="folder written by KnowledgeGraph.save")
    pl.add_argument("--lexicon", default=None, help="parquet folder of (word, tag), as the job lexicon writes it")
    pl.add_argument("--out", default="data/out")
    pl.add_argument("--stage-dir", default=None)
    pl.add_argument("--ordered", action="store_true")
    pl.add_argument("--show", type=int, default=0)
    common(pl)
    pl.set_defaults(fn=cmd_link)

    ps = sub.add_parser("score")
    ps.add_argument("gold")
    ps.add_argument("pred")
    ps.add_argument("type", choices=["ENTITY", "RELATION"])
    ps.add_argument("--strict", action="store_true")
    ps.set_defaults(fn=cmd_score)

    pg = sub.add_parser("graph")
    pg.add_argument("--dumps", required=True, help="N-Triples files, plain or compressed")
    pg.add_argument("--out", required=True)
    pg.set_defaults(fn=cmd_graph)

    px = sub.add_parser("lexicon")
    px.add_argument("--tagged", required=True, help="parquet table of tagged words")
    px.add_argument("--word", default="word")
    px.add_argument("--tag", default="tag")
    px.add_argument("--out", required=True)
    px.set_defaults(fn=cmd_lexicon)

    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main(sys.argv[1:])
