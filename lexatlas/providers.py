"""Pluggable models with deterministic defaults: sentence encoder, relation judge, table-of-contents reader, segmenter.

A provider is a plain function of a DataFrame or Column; a remote model plugs in as another such function.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexatlas.functions.numbering import first_rows
from lexatlas.functions.text import collapse, first_level, strip, strip_fences
from lexatlas.operators.hierarchy import heading_text
from lexatlas.scratch import staged
from lexatlas.sources.buckets import read_buckets, upsert_buckets
from lexatlas.workers import ready_python

DIM = 256
UNREADABLE = "unreadable reply"


def hashed_vector(text: str | None, dim: int = DIM) -> list[float]:
    """A unit vector of hashed character n-grams (1 to 3): equal texts are equal, similar ones near."""
    t, v = (text or "").lower(), np.zeros(dim, np.float64)
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            h = zlib.crc32(t[i : i + n].encode("utf-8", "surrogatepass"), n)
            v[h % dim] += n if h >> 31 else -n
    size = float(np.sqrt((v * v).sum()))
    return (v / size if size else v).astype(np.float32).tolist()


def encoder(make: Callable[[], Callable[[list[str]], list]] | None = None, dim: int = DIM) -> Callable[[Column], Column]:
    """A column function text -> array<float>. make() is called once a worker task and returns a function of a list of texts."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make() if make else lambda texts: [hashed_vector(t, dim) for t in texts]
        for b in batches:
            yield pd.Series(list(encode(b.tolist())), index=b.index, dtype=object)

    def column(text: Column) -> Column:
        ready_python(SparkSession.active())
        return embed(text)

    return column


def rule_judge(asked: DataFrame) -> DataFrame:
    """decision and reason for (alias, name, content): equal names are high, one within the other is middle, else none."""
    a, n = F.lower(strip("alias")), F.lower(strip("name"))
    decision = F.when(a == n, "高关联").when(n.contains(a) | a.contains(n), "中关联").otherwise("无关联")
    return asked.withColumns({"decision": decision, "reason": F.lit("rule")})


def reply_judge(ask: Callable[[str, str, str], str]) -> Callable[[DataFrame], DataFrame]:
    """A judge from a function (alias, name, content) -> JSON reply, fenced or not. Failures and broken replies count as no relation."""

    def judge(asked: DataFrame) -> DataFrame:
        ready_python(asked.sparkSession)

        def safely(*question: str) -> str:
            try:
                return ask(*question)
            except Exception as e:  # a remote service may fail in any way; the row says so
                return '{"decision": "无关联", "reason": ' + json.dumps(f"failed: {e}") + "}"

        @F.pandas_udf("string")
        def reply(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for questions in batches:
                yield pd.Series([safely(*q) for q in zip(*questions, strict=True)], dtype=object)

        said = asked.withColumn("__r", F.from_json(strip_fences(reply.asNondeterministic()("alias", "name", "content")), "decision string, reason string"))
        return said.withColumns({"decision": F.coalesce("__r.decision", F.lit("无关联")), "reason": F.coalesce("__r.reason", F.lit(UNREADABLE))}).drop("__r")

    return judge


REPLIES = T.StructType([T.StructField(c, T.StringType()) for c in ("question", "decision", "reason")])


def question(alias: Column | str, name: Column | str, content: Column | str) -> Column:
    """The key of a question: equal ones have one; lengths and marks keep nulls and borders apart."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (alias, name, content)]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-")) for c in parts]), 256)


def kept_judge(judge: Callable[[DataFrame], DataFrame], path: str, *, attempts: int = 3, failed: Callable[[Column], Column] | None = None, buckets: int = 64) -> Callable[[DataFrame], DataFrame]:
    """A judge that asks each question once, ever: replies are kept at `path` by the hash of the question, in buckets, and what is kept isn't asked.

    Equal questions are one. Replies whose reason is `failed` (begins with "failed:" or is the note of an unreadable one, if not given) are asked again, up to
    `attempts` times in all, and not kept, so that a later run asks them anew. The judge's rows are laid down before they are used: a plan
    that is read twice doesn't ask twice.
    """
    bad = failed or (lambda reason: reason.startswith("failed:") | (reason == UNREADABLE))

    def kept(asked: DataFrame) -> DataFrame:
        spark = asked.sparkSession
        keyed = staged(asked.withColumn("__q", question("alias", "name", "content")), "asked")
        each = first_rows(keyed.select("__q", "alias", "name", "content"), ["__q"], ["alias"])
        open_ones = staged(each.join(read_buckets(spark, path, REPLIES), F.col("__q") == F.col("question"), "left_anti"), "open")
        last = spark.createDataFrame([], REPLIES)
        for _ in range(attempts):
            if open_ones.isEmpty():
                break
            said = staged(judge(open_ones).select(F.col("__q").alias("question"), "decision", "reason"), "said")
            good = said.where(~F.coalesce(bad(F.col("reason")), F.lit(False)))
            upsert_buckets(good, path, "question", buckets=buckets)
            last = said.join(good.select("question"), "question", "left_anti")
            open_ones = open_ones.join(last, F.col("__q") == F.col("question"), "left_semi")
        replies = read_buckets(spark, path, REPLIES).unionByName(last)
        return keyed.join(replies, F.col("__q") == F.col("question"), "left").select(*asked.columns, "decision", "reason")

    return kept


def toc_by_rules(docs: DataFrame, rules: list[tuple[int, str]], *, book: str = "book_id", text_col: str = "text") -> DataFrame:
    """Entries of a table of contents from its lines: a line that fits a rule is an entry of that level; its number is what the rule
    matches, its parent the last entry of a higher level."""
    lines = F.transform(F.split(F.col(text_col), "\n", -1), heading_text)
    each = docs.select(book, F.posexplode(lines).alias("ordinal", "line")).withColumn("level", first_level(F.col("line"), rules)).where("level is not null")
    number = F.coalesce(*[F.when(F.col("level") == lv, F.nullif(F.regexp_extract("line", f"^(?:{p})", 0), F.lit(""))) for lv, p in rules], F.lit(""))
    from pyspark.sql import Window as W

    before = W.partitionBy(book).orderBy("ordinal").rowsBetween(W.unboundedPreceding, -1)
    each = each.withColumn("number", number).withColumn("title", strip(F.expr("substring(line, length(number) + 1)")))
    above = F.lit(None).cast("string")
    for lv in sorted({lv for lv, _ in rules}):
        above = F.when(F.col("level") > lv, F.coalesce(F.last(F.when(F.col("level") == lv, F.col("number")), ignorenulls=True).over(before), above)).otherwise(above)
    return each.select(book, F.col("ordinal").cast("long").alias("ordinal"), "level", "number", "title", above.alias("parent_number"))


def segments_by_paragraph(sections: DataFrame, *, source: str = "source", section: str = "section", text_col: str = "text") -> DataFrame:
    """Segments of a section: a heading opens one, each further paragraph is one; type by the words of its beginning."""
    parts = F.filter(F.split(F.col(text_col), r"\n{2,}|\n(?=#)", -1), lambda p: strip(p) != "")
    each = sections.select(source, section, F.posexplode(parts).alias("idx", "raw_content"))
    first = F.split_part("raw_content", F.lit("\n"), F.lit(1))
    kinds = (("theorem", "定理|theorem"), ("proof", "证明|proof"), ("example", "例|example"), ("definition", "定义|definition"))
    kind = F.lit("note")
    for name, words in reversed(kinds):
        kind = F.when(heading_text(first).rlike(f"(?i)^(?:{words})"), name).otherwise(kind)
    none = F.array().cast("array<string>")
    return each.select(
        F.col(source).alias("source"), F.col(section).alias("section"), "idx", F.substring(heading_text(first), 1, 60).alias("title"), collapse("raw_content").alias("content"), "raw_content", kind.alias("type"),
        none.alias("aliases"), F.lit("").alias("entities"), none.alias("references"), F.lit(1.0).alias("confidence"), F.lit(False).alias("needs_review"), F.substring(collapse("raw_content"), 1, 80).alias("summary"),
    )
