"""python -m lexatlas.cli COMMAND: the steps from a book to a queryable knowledge base.

  tree STRUCTURE OUT                        chapters from a table-of-contents JSON file
  toc INPUT STRUCTURE OUT                   entries of a table of contents by the heading rules of STRUCTURE
  normalise INPUT STRUCTURE OUT             headings normalised by these rules
  split INPUT OUT                           a book as files of chapters, sections and subsections
  segment INPUT OUT --source S --section N  segments of a section file; --section-id, --chapters
  batch MANIFEST OUT                        segments of all files in a CSV of path, section; a file that can't be read is reported
  build SEGMENTS BASE [--rebuild]           concepts and aliases from segment JSON, as an increment or anew
  store SEGMENTS OUT                        segments with embeddings for semantic search
  align BASE [--rerun]                      aliases aligned to concepts
  annotate INPUT OUT BASE [--inline]        texts annotated with the aligned aliases
  query BASE concepts|aliases|review|text|alias|assign|counts [ARG ...]
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas import providers
from lexatlas.operators import align, annotate, concepts, hierarchy, search, sections
from lexatlas.schemas import ALIASES, CHAPTERS, CONCEPTS, METADATA
from lexatlas.session import Options, session
from lexatlas.sources import readers, sinks
from lexatlas.streaming.incremental import increment


def _base(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return readers.read_table(spark, f"{folder}/concepts", CONCEPTS), readers.read_table(spark, f"{folder}/aliases", ALIASES)


def _segments(spark: SparkSession, files: DataFrame, a, o: Options) -> DataFrame:
    chapters = readers.read_table(spark, a.chapters, CHAPTERS) if a.chapters else spark.createDataFrame([], CHAPTERS)
    raw = providers.segments_by_paragraph(files)
    return sections.finish_segments(raw, chapters, created_at=o.created_at, model=o.model, version=o.version, section_id=getattr(a, "section_id", None))


def _show(df: DataFrame) -> None:
    """All rows, a line each, as they come."""
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join("" if v is None else str(v) for v in row))


def run(a: argparse.Namespace, spark: SparkSession, o: Options) -> None:
    if a.command == "tree":
        texts = readers.read_texts(spark, a.structure).withColumn("book_id", F.col("path"))
        sinks.overwrite(hierarchy.chapters(hierarchy.chapter_tree(hierarchy.toc_entries(texts), a.title)), a.out)
    elif a.command == "toc":
        texts = readers.read_texts(spark, a.input).withColumn("book_id", F.col("path"))
        sinks.overwrite(providers.toc_by_rules(texts, hierarchy.heading_rules(spark, a.structure)), a.out)
    elif a.command == "normalise":
        texts = hierarchy.normalise_headings(readers.read_texts(spark, a.input), hierarchy.heading_rules(spark, a.structure))
        sinks.write_texts(texts.select(F.col("name").alias("path"), F.col("text").alias("content")), a.out)
    elif a.command == "split":
        sinks.write_texts(sections.section_files(readers.read_texts(spark, a.input).withColumn("doc_id", F.col("path"))), a.out)
    elif a.command == "segment":
        files = readers.read_texts(spark, a.input).select(F.lit(a.source or "").alias("source"), F.lit(a.section).alias("section"), "text")
        done = _segments(spark, files, a, o)
        sinks.write_texts(sinks.json_array(done, "position").select(F.lit(a.out.rpartition("/")[2]).alias("path"), F.col("value").alias("content")), a.out.rpartition("/")[0] or ".")
    elif a.command == "batch":
        listed = spark.read.csv(a.manifest, schema="file string, section string")
        texts = readers.read_texts(spark, a.root, recursive=True)
        joined = sections.listed_texts(listed, texts)
        _show(joined.where("text is null").select("file", F.lit("not found").alias("error")))
        files = joined.where("text is not null").select(F.col("file").alias("source"), "section", "text")
        _segments(spark, files, a, o).write.mode("overwrite").json(a.out)
    elif a.command == "build":
        if a.rebuild:
            for name, schema in (("concepts", CONCEPTS), ("aliases", ALIASES)):
                sinks.overwrite(spark.createDataFrame([], schema), f"{a.base}/{name}")
        segments = readers.read_json_array(spark, a.segments)
        increment(spark, segments, a.base, providers.encoder())
        sinks.overwrite(concepts.metadata(segments, o.model), f"{a.base}/metadata")
        _show(concepts.extract_aliases(segments).groupBy("alias_type").count())
    elif a.command == "store":
        segments = readers.read_json_array(spark, a.segments)
        sinks.overwrite(concepts.knowledge_segments(segments, providers.encoder()), f"{a.out}/segments")
        sinks.overwrite(concepts.metadata(segments, o.model), f"{a.out}/metadata")
        _show(concepts.type_counts(segments))
    elif a.command == "align":
        known, aliases = _base(spark, a.base)
        sinks.overwrite(align.align(aliases, known, providers.rule_judge, threshold=o.threshold, rerun=a.rerun), f"{a.base}/aliases")
        _show(align.status_counts(_base(spark, a.base)[1]))
    elif a.command == "annotate":
        known, aliases = _base(spark, a.base)
        texts = readers.read_texts(spark, a.input)
        done = annotate.annotate(texts, annotate.load_dictionary(aliases, known), id_col="path")
        files = annotate.rendered(done, inline_links=a.inline).select(F.concat(F.regexp_replace("name", r"\.[^.]*$", ""), F.lit("_annotated.md")).alias("path"), F.col("annotated").alias("content"))
        sinks.write_texts(files, a.out)
    else:
        query(spark, a, o)


def query(spark: SparkSession, a: argparse.Namespace, o: Options) -> None:
    known, aliases = _base(spark, a.base)
    text = a.args[0] if a.args else ""
    if a.what == "assign":
        done, ok = search.manual_assign(aliases, known, *a.args)
        if ok:
            sinks.overwrite(done, f"{a.base}/aliases")
        print("assigned" if ok else "no such alias or concept")
        return
    found = {
        "concepts": lambda: search.list_concepts(known),
        "aliases": lambda: search.displayed(search.list_aliases(aliases, known, text or None)).select("line"),
        "review": lambda: search.needs_review(aliases, known),
        "text": lambda: search.search_text(known, text, providers.hashed_vector, o.top_k).select("concept_id", "name", "similarity", "content"),
        "alias": lambda: search.search_alias(aliases, known, text),
        "counts": lambda: align.status_counts(aliases),
        "metadata": lambda: readers.read_table(spark, f"{a.base}/metadata", METADATA),
    }
    _show(found[a.what]())


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--env", default=".env")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *positional: str, **flags) -> None:
        c = sub.add_parser(name)
        for x in positional:
            c.add_argument(x)
        for x, kind in flags.items():
            c.add_argument(f"--{x.replace('_', '-')}", **({"action": "store_true"} if kind is bool else {"default": kind}))

    add("tree", "structure", "out", title="")
    add("toc", "input", "structure", "out")
    add("normalise", "input", "structure", "out")
    add("split", "input", "out")
    add("segment", "input", "out", source=None, section=None, section_id=None, chapters=None)
    add("batch", "manifest", "root", "out", chapters=None)
    add("build", "segments", "base", rebuild=bool)
    add("store", "segments", "out")
    add("align", "base", rerun=bool)
    add("annotate", "input", "out", "base", inline=bool)
    q = sub.add_parser("query")
    q.add_argument("base")
    q.add_argument("what", choices=("concepts", "aliases", "review", "text", "alias", "assign", "counts", "metadata"))
    q.add_argument("args", nargs="*")
    return p


def main(argv: list[str] | None = None) -> None:
    a, began = parser().parse_args(argv), time.monotonic()
    run(a, session(), Options.load(a.env))
    print(f"{a.command}: {time.monotonic() - began:.1f} s")


if __name__ == "__main__":
    main()
