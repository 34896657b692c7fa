"""Splitting markdown into chapters, sections and subsections, and the clean-up of segments.

One DataFrame replaces nested folders: path, level, ordinal, title, body. `export_path` gives the layout as files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexatlas.functions.scans import places
from lexatlas.functions.text import WS, collapse, sanitize_filename, split_at_headings, stem, strip
from lexatlas.operators.hierarchy import section_lookup

#: Fixed value: what the first chapter's heading begins with; where it stands twice, the first is the table of contents.
FIRST_CHAPTER = "第一章"
MARK = "_标准化"


def separate_toc(docs: DataFrame, text_col: str = "text", first: str = FIRST_CHAPTER) -> DataFrame:
    """docs with toc (null if there is none), main (null if no first chapter is found)."""
    pieces = F.split(F.col(text_col), rf"(?mdU)(?=^#{WS}+\Q{first}\E)", -1)
    starts = F.filter(pieces, lambda p: p.rlike(rf"(?U)\A#{WS}+\Q{first}\E"))
    head = F.when(F.get(pieces, F.lit(0)).rlike(rf"(?U)\A#{WS}+\Q{first}\E"), F.lit("")).otherwise(F.get(pieces, F.lit(0)))
    n = F.size(starts)
    toc = F.when(n >= 2, strip(F.concat(head, F.get(starts, F.lit(0)))))
    rest = strip(F.array_join(F.slice(starts, 2, F.greatest(n - 1, F.lit(1))), ""))
    return docs.withColumn("toc", toc).withColumn("main", F.when(n >= 2, rest).when(n == 1, strip(F.col(text_col))))


def _title(piece: Column, level: int) -> Column:
    first = F.split_part(piece, F.lit("\n"), F.lit(1))
    found = F.regexp_extract(first, rf"(?dU)^{'#' * level}{WS}+(.+)\z", 1)
    return F.when(found != "", strip(found))


def split_h1(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Chapters: id, ordinal, title, body. A chapter's first line begins with "# "."""
    pieces = F.transform(split_at_headings(text_col, 1), strip)
    each = docs.select(id_col, F.posexplode(pieces).alias("ordinal", "body")).where(F.col("body") != "")
    first = strip(F.split_part("body", F.lit("\n"), F.lit(1)))
    return each.where(first.startswith("# ")).select(id_col, "ordinal", strip(F.substring(first, 3, F.lit(2**30))).alias("title"), "body")


def split_h2(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sections: id, ordinal, title, body, the heading raised to level 1. What stands before the first is left out."""
    each = docs.select(id_col, F.posexplode(split_at_headings(text_col, 2)).alias("ordinal", "body")).where(strip("body") != "")
    each = each.withColumn("title", _title(F.col("body"), 2)).where("title is not null")
    return each.select(id_col, "ordinal", "title", F.regexp_replace("body", rf"(?U)\A##{WS}+", "# ").alias("body"))


def split_h3(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Subsections: id, ordinal, title, body, headings as they are; only of texts with more than one piece."""
    pieces = F.filter(split_at_headings(text_col, 3), lambda p: strip(p) != "")
    each = docs.where(F.size(pieces) > 1).select(id_col, F.posexplode(pieces).alias("ordinal", "body"))
    return each.withColumn("title", _title(F.col("body"), 3)).where("title is not null").select(id_col, "ordinal", "title", "body")


def last_by_path(rows: DataFrame, path: str, ordinal: str = "ordinal") -> DataFrame:
    """One row for each path: the last, as later files overwrite earlier ones."""
    values = [c for c in rows.columns if c != path]
    return rows.groupBy(path).agg(F.max_by(F.struct(*values), ordinal).alias("__r")).select(path, "__r.*").select(rows.columns)


def section_files(books: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The files that splitting a book on three levels leaves: book, path, content."""
    main = separate_toc(books, text_col).where("main is not null")
    h1 = split_h1(main, id_col=id_col, text_col="main").withColumn("chapter", sanitize_filename(F.concat(F.col("title"), F.lit(f"{MARK}.md"))))
    h1 = h1.withColumn("chapter", F.replace(stem("chapter"), F.lit(MARK), F.lit("")))
    h1 = last_by_path(h1.select(F.struct(id_col, "chapter").alias("key"), "ordinal", "body"), "key")
    sources = h1.select(F.col("key"), F.concat("key.chapter", F.lit("/"), "key.chapter", F.lit("_源文件.md")).alias("path"), F.col("body").alias("content"))
    h2 = split_h2(h1, id_col="key", text_col="body").withColumn("folder", sanitize_filename("title"))
    h2 = last_by_path(h2.select(F.struct("key", "folder").alias("at"), "ordinal", "body"), "at")
    inner = h2.select(F.col("at.key").alias("key"), F.concat("at.key.chapter", F.lit("/"), "at.folder", F.lit("/"), "at.folder", F.lit(".md")).alias("path"), F.col("body").alias("content"), F.lit(-1).alias("ordinal"))
    h3 = split_h3(h2, id_col="at", text_col="body")
    h3 = h3.select(F.col("at.key").alias("key"), F.concat("at.key.chapter", F.lit("/"), "at.folder", F.lit("/"), sanitize_filename("title"), F.lit(".md")).alias("path"), F.col("body").alias("content"), "ordinal")
    every = inner.unionByName(h3).unionByName(sources.withColumn("ordinal", F.lit(-1)))
    every = every.select(F.struct(F.col(f"key.{id_col}").alias("book"), "path").alias("file"), "content", "ordinal")
    return last_by_path(every, "file").select("file.book", "file.path", "content")


def listed_texts(listed: DataFrame, texts: DataFrame) -> DataFrame:
    """listed (file, ...) with path and text of the file: the one whose path ends with `file`, from a slash on; of several the first by
    path. Files that aren't found have nulls. Only paths are matched; texts come by an equality join afterwards."""
    parts = F.split("path", "/")
    tails = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))
    found = texts.select("path", F.explode(tails).alias("file")).join(listed.select("file").distinct(), "file").groupBy("file").agg(F.min("path").alias("path"))
    return listed.join(found, "file", "left").join(texts.select("path", "text"), "path", "left").select(*listed.columns, "path", "text")


def finish_segments(raw: DataFrame, chapters: DataFrame, *, created_at: str, model: str, version: int = 1, source: str = "source", order: str = "idx", section_id: str | None = None, partitions: int | None = None) -> DataFrame:
    """Segments as stored: content without surplus white space, section_id looked up (a given one wins), positions 1..n in each
    source by `order`, creation time, model and version as given. A source may have any number of segments: positions are a prefix scan."""
    names = raw.drop("section_id", "position", "created_at", "model", "version")
    found = section_lookup(names.select("section").distinct(), chapters)
    out = names.join(found, "section", "left").withColumn("content", collapse("content"))
    if section_id is not None:
        out = out.withColumn("section_id", F.lit(section_id))
    out = places(out, "position", [source], [order], partitions).withColumn("position", F.col("position").cast("int"))
    return out.withColumns({"created_at": F.lit(created_at), "model": F.lit(model), "version": F.lit(version)}).drop(order)
