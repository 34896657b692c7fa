"""Chapter trees from tables of contents, heading rules, and lookups of sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexatlas.functions.scans import CARRY, Scan, ranged_scan
from lexatlas.functions.text import chapters_rest, cut_array, first_filled, first_level, lstrip, repair_json_backslashes, strip
from lexatlas.schemas import CHAPTERS, TOC, conform
from lexatlas.workers import ready_python


def toc_entries(structure: DataFrame, text_col: str = "text", book: str = "book_id") -> DataFrame:
    """Entries of table-of-contents JSON texts, in order: book, ordinal, level, number, title, parent_number. The array behind
    "chapters" is taken wherever it stands; backslashes that JSON doesn't know are repaired. Entries are parsed one by one: one that
    doesn't parse costs no other, keeps its place in the numbers, and is told by toc_rejects."""
    return _parsed_entries(structure, text_col, book).where("bad is null").select(
        book, F.col("ordinal").cast("long"), F.coalesce("e.level", F.lit(1)).alias("level"), F.coalesce("e.编号", F.lit("")).alias("number"),
        first_filled("e.标题", "e.title").alias("title"), F.col("e.父级编号").alias("parent_number"),
    )


def _parsed_entries(structure: DataFrame, text_col: str, book: str) -> DataFrame:
    """book, ordinal, raw, e, bad (the text of an entry that doesn't parse)."""
    ready_python(structure.sparkSession)
    entry = T.StructType([*TOC["chapters"].dataType.elementType.fields, T.StructField("__bad", T.StringType())])
    raw = structure.select(book, F.posexplode(cut_array(repair_json_backslashes(chapters_rest(text_col)))).alias("ordinal", "raw"))
    each = raw.withColumn("e", F.from_json("raw", entry, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))
    # null and other values that are no objects are no entries either
    return each.withColumn("bad", F.when(F.col("e").isNull() | F.col("e.__bad").isNotNull() | ~F.col("raw").startswith("{"), F.col("raw")))


def toc_rejects(structure: DataFrame, text_col: str = "text", book: str = "book_id") -> DataFrame:
    """book, ordinal (the place in the array), raw: entries that don't parse; with ordinal null, texts that have no array of chapters."""
    broken = _parsed_entries(structure, text_col, book).where("bad is not null").select(book, F.col("ordinal").cast("long").alias("ordinal"), F.col("bad").alias("raw"))
    none = structure.where(chapters_rest(text_col).isNull()).select(book, F.lit(None).cast("long").alias("ordinal"), F.col(text_col).alias("raw"))
    return broken.unionByName(none)


def heading_rules(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(level, pattern) in order from the summary of a structure file; rules without a pattern are skipped. A few per book."""
    got = spark.read.schema(TOC).json(path, multiLine=True).select(F.posexplode("structure_summary.层级定义").alias("k", "r"))
    return [(r["level"], r["f"]) for r in got.where("r.`编号格式` <> ''").orderBy("k").select(F.coalesce("r.level", F.lit(1)).alias("level"), F.col("r.编号格式").alias("f")).collect()]


class _Open:
    """The entries of a run that are still open, outermost first, as (level, place, number); places count from 1 in the run."""

    def __init__(self):
        self.n, self.lowest, self.top, self.stack = 0, None, False, []

    def step(self, level: int | None, number: str | None, parent: str | None) -> tuple:
        self.n += 1
        if level is None:
            return self.n, None, None, None, self.top
        above = [x for x in self.stack if x[0] < level]
        named = next((x[1] for x in reversed(above) if parent is not None and x[2] == parent), None)
        out = (self.n, named, above[-1][1] if above else None, level if self.lowest is None else min(level, self.lowest), self.top)
        self.stack = above
        self.lowest = out[3]
        if level >= 0:
            self.stack.append((level, self.n, number))
        self.top |= level == 0
        return out

    def close(self) -> dict:
        return {"n": self.n, "lowest": self.lowest, "top": self.top, "stack": [dict(zip(("level", "at", "number"), x, strict=True)) for x in self.stack]}


def _behind(a: dict, b: dict) -> dict:
    """What two runs leave open: the second closes those of the first from its lowest level on."""
    left = a["stack"] if b["lowest"] is None else [x for x in a["stack"] if x["level"] < b["lowest"]]
    lows = [x for x in (a["lowest"], b["lowest"]) if x is not None]
    moved = [{**x, "at": x["at"] + a["n"]} for x in b["stack"]]
    return {"n": a["n"] + b["n"], "lowest": min(lows, default=None), "top": a["top"] or b["top"], "stack": left + moved}


#: Level stacks as a prefix scan: what a run of entries closes and what it leaves open.
STACKS = Scan(
    ("level", "number", "parent_number"), "__at long, __named long, __nearest long, __below int, __top boolean", "n long, lowest int, top boolean, stack array<struct<level:int,at:long,number:string>>",
    _Open, _Open.step, _Open.close, _behind,
)


def chapter_tree(entries: DataFrame, root_title: Column | str = "", *, book: str = "book_id", partitions: int | None = None) -> DataFrame:
    """entries (book, ordinal, level, number, title, parent_number) -> book and CHAPTERS: the root is 1, entries follow as 2, 3, ...

    An entry's parent is the nearest open one above its level whose number is parent_number (the root goes by its title), else the
    nearest open one at all, else the root; without a parent_number it is the root. An entry closes all of its level and below; one of
    level 0 takes the root's place as the topmost open one, one below 0 is never open, one without a level changes nothing. Entries of one
    ordinal follow by level, number, title and parent. A book may lie in any number of partitions (see scans): only what is open at
    a partition's end, an entry a level, goes from one to the next.
    """
    title = F.lit(root_title) if isinstance(root_title, str) else root_title
    rows = entries.select(book, "ordinal", F.col("level").cast("int").alias("level"), "number", "title", "parent_number")
    e = ranged_scan(rows, [book], ["ordinal", "level", "number", "title", "parent_number"], STACKS, partitions)
    before = F.coalesce(F.col(f"{CARRY}.n"), F.lit(0))
    still = F.reverse(F.filter(f"{CARRY}.stack", lambda x: x["level"] < F.col("__below")))
    first = lambda found: F.get(found, F.lit(0))["at"]
    topmost = ~F.col("__top") & ~F.coalesce(F.col(f"{CARRY}.top"), F.lit(False))
    root = F.when(topmost & (F.col("level") > 0) & (F.col("parent_number") == title), F.lit(0))
    found = F.coalesce(before + F.col("__named"), first(F.filter(still, lambda x: x["number"] == F.col("parent_number"))), root, before + F.col("__nearest"), first(still), F.lit(0))
    parent = F.when(F.col("parent_number").isNull(), F.lit(0)).otherwise(found) + 1
    tree = e.select(book, (before + F.col("__at") + 1).alias("id"), "level", "number", "title", parent.cast("long").alias("parent_id"))
    roots = entries.select(book).distinct().select(book, F.lit(1).cast("long").alias("id"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("number"), title.alias("title"), F.lit(None).cast("long").alias("parent_id"))
    return roots.unionByName(tree)


def chapters(tree: DataFrame) -> DataFrame:
    return conform(tree, CHAPTERS)


def section_lookup(names: DataFrame, chapters: DataFrame, name_col: str = "section") -> DataFrame:
    """names with section_id: of the chapters whose title is the name the smallest id, else of those whose number is; as text."""
    by = lambda c, to: chapters.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(to)).agg(F.min("id").alias(f"{to}_id"))
    found = names.join(by("title", "__t"), F.col(name_col) == F.col("__t"), "left").join(by("number", "__n"), F.col(name_col) == F.col("__n"), "left")
    return found.select(*names.columns, F.coalesce("__t_id", "__n_id").cast("string").alias("section_id"))


def heading_text(line: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(strip(line), r"^#+(?U)[\s\x1c-\x1f]*", ""), r"^\*+(?U)[\s\x1c-\x1f]*", "")
    return F.regexp_replace(bare, r"(?U)[\s\x1c-\x1f]*\*+\z", "")


def normalise_line(line: Column, rules: list[tuple[int, str]]) -> Column:
    """A heading by the first rule that fits it, as plain text if none does; other lines as they are."""
    content = heading_text(line)
    level = first_level(content, rules)
    made = F.when(level.isNull(), content).otherwise(F.concat(F.repeat(F.lit("#"), level), F.lit(" "), content))
    return F.when(lstrip(line).startswith("#"), made).otherwise(line)


def normalise_headings(docs: DataFrame, rules: list[tuple[int, str]], text_col: str = "text") -> DataFrame:
    """docs with the headings of the text normalised, also those inside code fences. Lines stay in their row: nothing is shuffled."""
    lines = F.transform(F.split(F.col(text_col), "\n", -1), lambda x: normalise_line(x, rules))
    return docs.withColumn(text_col, F.array_join(lines, "\n"))
