"""Dictionary matching and annotation of markdown texts.

A dictionary is a DataFrame (alias, concept_id, concept_name, alias_type, status, confidence). Two matchers find all occurrences of
all aliases, overlapping ones included: `matches_automaton` runs an Aho-Corasick automaton over whole texts in Arrow batches; of
dictionaries above CHUNK entries each part of the texts gets those that it may hold (see anchors); `matches_native` stays in the JVM for small dictionaries. Both give the
same rows. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexatlas.functions.numbering import first_rows
from lexatlas.functions.text import SKIP, fixed, lookup
from lexatlas.operators import anchors
from lexatlas.schemas import CONFIRMED
from lexatlas.scratch import staged
from lexatlas.workers import ready_python

#: Aliases in one automaton, and their characters.
CHUNK, CHARACTERS = 20_000, 1 << 22
SPAN = "struct<start:int,end:int,alias:string,concept_id:string,concept_name:string,alias_type:string,status:string,confidence:double>"
SPAN_LIST = f"array<{SPAN}>"
_SKIP = [re.compile(p.removeprefix("(?d)")) for p in SKIP]
#: The parts of an annotation.
TYPE_LABELS = {"concept": "概念本身", "alias": "别名", "entity": "实体词"}
TABLE_HEAD = (
    "\n\n---\n## 📌 概念对齐注释\n> 本节由程序自动生成，列出文中已与概念库对齐的关键词。\n\n"
    "| 出现词 | 对齐概念 | 概念ID | 类型 | 置信度 |\n|--------|---------|--------|------|--------|\n"
)
NO_MATCH = "\n\n---\n\n> ℹ️ 未找到与概念库对齐的关键词。\n"


def load_dictionary(aliases: DataFrame, concepts: DataFrame, statuses=CONFIRMED) -> DataFrame:
    """Aliases of the given statuses that lead to a named concept."""
    names = concepts.select("concept_id", F.col("name").alias("concept_name"))
    found = aliases.where(F.col("status").isin(*statuses)).where("alias <> '' and concept_id <> ''").join(names, "concept_id").where("concept_name <> ''")
    return found.select("alias", "concept_id", "concept_name", "alias_type", "status", "confidence")


def finder(words: list[str]):
    """A function text -> numbers of words, starts and ends of all their occurrences."""
    a = ahocorasick.Automaton()
    for k, w in enumerate(words):
        a.add_word(w, k)
    a.make_automaton()
    sizes = np.array([len(w) for w in words], np.int64)

    def find(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = np.array(list(a.iter(text)) if text and words else [], np.int64).reshape(-1, 2)
        k, end = found[:, 1], found[:, 0] + 1
        return k, end - sizes[k], end

    return find


def few(words: DataFrame, word_col: str, chunk: int) -> list[str] | None:
    """The words, if they are few and short enough for one automaton on every worker; else None."""
    r = words.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(word_col)), F.lit(0)).alias("size")).first()
    return [w[0] for w in words.select(word_col).collect()] if r["n"] <= chunk and r["size"] <= CHARACTERS else None


def keyed(docs: DataFrame, text_col: str, key: str) -> DataFrame:
    """docs with `key`, a number of the text: copies have one, a null text has none."""
    return docs.withColumn(key, F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col)))


def _in_parts(docs: DataFrame, words: DataFrame, work, schema: str) -> DataFrame:
    """work(aliases, rows, found) for some rows of texts of a part of docs (id, text): its aliases, and what is found in each text."""

    def begin(entries: pa.StructArray):
        aliases = entries.field(0)
        find = finder(aliases.to_pylist())
        return lambda rows: work(aliases, rows, [find(t) for t in rows.field(1).to_pylist()])

    texts, n = anchors.parts(docs, "text")
    return anchors.met(texts, n, anchors.dictionaries(texts, words, text_col="text"), begin, schema)


def matches_automaton(docs: DataFrame, words: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", word_col: str = "alias", chunk: int = CHUNK) -> DataFrame:
    """id, alias, start, end of every occurrence. words: distinct non-empty strings. Up to `chunk` words are one automaton on every worker;
    more go the way of the anchor index."""
    ready_python(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    words = staged(words.select(F.col(word_col).alias("alias")), "words")
    known = few(words, "alias", chunk)
    if known is None:

        def each(aliases: pa.Array, rows: pa.StructArray, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            k, start, end = (np.concatenate([f[i] for f in found]) for i in range(3))
            which = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            return pa.RecordBatch.from_arrays([rows.field(0).take(which), aliases.take(pa.array(k)), pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["id", "alias", "start", "end"])

        return _in_parts(pairs, words, each, f"id {id_type}, alias string, start int, end int").withColumnRenamed("id", id_col)
    packed = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = finder(packed.value)
        for b in batches:
            yield _found(b["id"], b["text"], find)

    return pairs.mapInPandas(run, f"id {id_type}, alias string, start int, end int").withColumnRenamed("id", id_col)


def _found(ids, texts, find) -> pd.DataFrame:
    rows = [(i, t[a:b], a, b) for i, t in zip(ids, texts, strict=True) for a, b in zip(*(x.tolist() for x in find(t)[1:]), strict=True)]
    return pd.DataFrame(rows, columns=["id", "alias", "start", "end"])


def match_counts(docs: DataFrame, words: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", word_col: str = "alias", chunk: int = CHUNK) -> DataFrame:
    """alias, n, sum_start, n_docs: how often each alias that occurs does, the sum of its starts, and in how many ids. As matches_automaton, but where
    ids occur once, as they should, a part of the texts counts its own matches, and only counts are shuffled."""
    totals = lambda n, start, ids: [n.alias("n"), start.alias("sum_start"), ids.alias("n_docs")]
    words = staged(words.select(F.col(word_col).alias("alias")), "words")
    if few(words, "alias", chunk) is not None or not ids_once(docs, id_col):
        found = matches_automaton(docs, words, id_col=id_col, text_col=text_col, chunk=chunk)
        return found.groupBy("alias").agg(*totals(F.count(F.lit(1)), F.sum("start"), F.countDistinct(id_col)))
    ready_python(docs.sparkSession)

    def counted(aliases: pa.Array, rows: pa.StructArray, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        n, starts, ids = np.zeros((3, len(aliases)), np.int64)
        for (k, start, _), known in zip(found, rows.field(0).is_valid().to_pylist(), strict=True):
            np.add.at(n, k, 1)
            np.add.at(starts, k, start)
            if known:
                ids[np.unique(k)] += 1
        at = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([aliases.take(pa.array(at)), *(pa.array(x[at]) for x in (n, starts, ids))], ["alias", "n", "sum_start", "n_docs"])

    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    parts = _in_parts(pairs, words, counted, "alias string, n long, sum_start long, n_docs long")
    return parts.groupBy("alias").agg(*totals(F.sum("n"), F.sum("sum_start"), F.sum("n_docs")))


def ids_once(docs: DataFrame, id_col: str) -> bool:
    return docs.groupBy(id_col).count().where("count > 1").isEmpty()


def matches_native(docs: DataFrame, words: list[str], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As matches_automaton, for a few words, by splitting at lookaheads: id, alias, start, end."""
    text = F.col(text_col)

    def starts(word: str) -> Column:
        quoted = "\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E"
        sizes = F.transform(F.split(text, f"(?={quoted})", -1), lambda p: F.length(p))
        ends = F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda s, n: F.struct((s["at"] + n).alias("at"), F.array_append(s["out"], s["at"] + n).alias("out")), lambda s: s["out"])
        # a split leaves no empty first piece, so a match at the beginning is added
        inner = F.filter(ends, lambda e: e < F.length(text))
        return F.when(text.startswith(word), F.concat(F.array(F.lit(0)), inner)).otherwise(inner)

    each = [F.when(text.contains(w), starts(w)).otherwise(F.array().cast("array<int>")) for w in words]
    named = [F.transform(F.array_distinct(e), _span(w)) for e, w in zip(each, words, strict=True)]
    every = F.concat(*named) if named else F.array().cast("array<struct<alias:string,start:int,end:int>>")
    return docs.where(text.isNotNull()).select(id_col, F.explode(every).alias("m")).select(id_col, "m.alias", "m.start", "m.end")


def _span(word: str):
    return lambda s: F.struct(F.lit(word).alias("alias"), s.alias("start"), (s + len(word)).cast("int").alias("end"))


def resolved_spans(text: str, find) -> list[tuple[int, int]]:
    """The spans of one text, of the matches find(text): those that stay."""
    start, end = np.array(sorted(set(find(text))), np.int64).reshape(-1, 2).T
    at = staying(text, start, end)
    return list(zip(start[at].tolist(), end[at].tolist(), strict=True))


def staying(text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which matches in one text stay, by start: those of which neither end lies in a skipped region, longest first, then by start. Regions are
    merged and searched as sorted lists. Of an island of overlapping matches one that covers it is left alone; only others are gone through."""
    inside: list[list[int]] = []
    for a, b in sorted(m.span() for p in _SKIP for m in p.finditer(text)):
        if inside and a <= inside[-1][1]:
            inside[-1][1] = max(inside[-1][1], b)
        else:
            inside.append([a, b])
    begins, ends = np.array([[-1, -1], *inside], np.int64).T

    def skipped(at: np.ndarray) -> np.ndarray:
        return at < ends[np.searchsorted(begins, at, "right") - 1]

    at = np.flatnonzero(~(skipped(start) | skipped(end - 1)))
    if not len(at):
        return at
    at = at[np.lexsort((-end[at], start[at]))]
    a, b = start[at], end[at]
    reach = np.maximum.accumulate(b)
    first = np.flatnonzero(np.concatenate([[True], a[1:] >= reach[:-1]]))
    after = np.append(first[1:], len(at))
    whole = b[first] == reach[after - 1]
    kept = [first[whole]]
    for i, j in zip(first[~whole].tolist(), after[~whole].tolist(), strict=True):
        some: list[tuple[int, int, int]] = []
        for m in sorted(zip(a[i:j].tolist(), b[i:j].tolist(), range(i, j), strict=True), key=lambda m: (m[0] - m[1], m[0])):
            k = bisect_left(some, m)
            if (k == len(some) or m[1] <= some[k][0]) and (k == 0 or some[k - 1][1] <= m[0]):
                some.insert(k, m)
        kept.append(np.array([k for _, _, k in some], np.int64))
    return at[np.sort(np.concatenate(kept))]


NAMES = tuple(f.partition(":")[0] for f in SPAN[7:-1].split(","))


def span_list(fields) -> str:
    """The type of spans that have only these of NAMES."""
    return f"array<struct<{','.join(f for f in SPAN[7:-1].split(',') if f.partition(':')[0] in fields)}>>"


def _kept(text: str | None, find) -> list[np.ndarray]:
    found = find(text)
    at = staying(text, *found[1:]) if len(found[0]) else found[0]
    return [x[at] for x in found]


def annotate(docs: DataFrame, dictionary: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, fields=NAMES) -> DataFrame:
    """docs with `spans`: the resolved matches of each text, outside code, formulas and images, longest first, by start. Of dictionary
    entries with the same alias the first by concept, name, type, status and confidence counts. fields: those of NAMES that spans have; others
    are neither laid down nor shuffled, and of the dictionary only its words if spans need no more.

    Up to `chunk` aliases go to every worker, which annotates texts where they are: nothing is shuffled. Of larger dictionaries each part of
    the texts gets the entries that it may hold; a text meets them by its part, whatever its id, where it is read: texts aren't shuffled, and
    nothing is joined by word. Both ways resolve matches by the same function.
    """
    ready_python(docs.sparkSession)
    shown, more = [c for c in NAMES if c in fields], [c for c in NAMES[3:] if c in fields]
    entries = first_rows(dictionary.select(*NAMES[2:]), ["alias"], list(NAMES[3:])).select("alias", *more) if more else dictionary.select("alias").distinct()
    entries = staged(entries, "entries")
    if few(entries, "alias", chunk) is not None:
        shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in entries.collect()])  # `chunk` rows at most

        @F.pandas_udf(span_list(fields))
        def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = shared.value
            find = finder([e[0] for e in known])
            whole = ("start", "end", "alias", *more)
            for texts in batches:
                found = ([dict(zip(whole, (a, b, *known[k]), strict=True)) for k, a, b in zip(*(x.tolist() for x in _kept(t, find)), strict=True)] for t in texts)
                yield pd.Series([[{c: m[c] for c in shown} for m in each] for each in found], dtype=object)

        return docs.withColumn("spans", spans(F.col(text_col)))
    columns, at = docs.columns, docs.columns.index(text_col)

    def begin(entries: pa.StructArray):
        find = finder(entries.field(0).to_pylist())

        def annotated(rows: pa.StructArray) -> pa.RecordBatch:
            kept = [_kept(t, find) for t in rows.field(at).to_pylist()]
            ends = pa.array(np.cumsum([0, *(len(k) for k, _, _ in kept)]), pa.int32())
            k, start, end = (np.concatenate([m[i] for m in kept]) for i in range(3))
            values = dict(zip(("start", "end", "alias", *more), (pa.array(start, pa.int32()), pa.array(end, pa.int32()), *entries.take(pa.array(k)).flatten()), strict=True))
            spans = pa.StructArray.from_arrays([values[c] for c in shown], shown)
            return pa.RecordBatch.from_arrays([*rows.flatten(), pa.ListArray.from_arrays(ends, spans)], [*columns, "spans"])

        return annotated

    texts, n = anchors.parts(docs, text_col)
    own = anchors.dictionaries(texts, entries, text_col=text_col)
    return anchors.met(texts, n, own, begin, StructType([*docs.schema.fields, *StructType.fromDDL(f"spans {span_list(fields)}").fields]))


def _linked(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for columns in batches:
        out = []
        for text, starts, ends, names in zip(*columns, strict=True):
            at, parts = 0, []
            for a, b, n in zip(starts, ends, names, strict=True):
                word = text[a:b]
                parts += [text[at:a], f"[[{n}]]" if word == n else f"[[{n}|{word}]]"]
                at = b
            out.append("".join([*parts, text[at:]]))
        yield pd.Series(out, dtype=object)


def inline(text: Column, spans: Column) -> Column:
    """The text with every span as [[concept|word]], or [[concept]] where they are the same."""
    start, end, names = F.transform(spans, lambda m: m["start"]), F.transform(spans, lambda m: m["end"]), F.transform(spans, lambda m: m["concept_name"])
    return F.when(F.size(spans) > 0, F.pandas_udf(_linked, "string")(text, start, end, names)).otherwise(text)


def annotation_rows(annotated: DataFrame, *, id_col: str = "doc_id", once: bool = False) -> DataFrame:
    """One row per document, word and concept, at its first span: id, start, alias, concept_name, concept_id, alias_type, label,
    confidence. once: ids occur once, so that the first spans of each text are all and nothing is shuffled."""
    each = annotated.select(id_col, F.explode(first_spans(F.col("spans"))).alias("m")).select(id_col, "m.*")
    if not once:
        first = F.min_by(F.struct("start", "concept_name", "alias_type", "confidence"), "start").alias("f")
        each = each.groupBy(id_col, "alias", "concept_id").agg(first).select(id_col, "alias", "concept_id", "f.*")
    return each.select(id_col, "start", "alias", "concept_name", "concept_id", "alias_type", lookup(F.col("alias_type"), TYPE_LABELS, F.col("alias_type")).alias("label"), "confidence")


def first_spans(spans: Column) -> Column:
    """The first of a text's spans of each word and concept."""

    @F.pandas_udf("array<int>")
    def places(starts: pd.Series, words: pd.Series, concepts: pd.Series) -> pd.Series:
        out = []
        for row in zip(starts, words, concepts, strict=True):
            first: dict[tuple, tuple[int, int]] = {}
            for k, (at, w, c) in enumerate(zip(*row, strict=True) if row[0] is not None else ()):
                first[w, c] = min(first.get((w, c), (at, k)), (at, k))
            out.append(sorted(k for _, k in first.values()))
        return pd.Series(out, dtype=object)

    column = lambda c: F.transform(spans, lambda m: m[c])
    return F.transform(places(column("start"), column("alias"), column("concept_id")), lambda k: F.get(spans, k))


def annotation_table(spans: Column) -> Column:
    """The markdown table of a text's spans: a line for each word and concept, at its first span."""
    value = lambda m: F.when(F.coalesce(m["confidence"], F.lit(0.0)) != 0, fixed(m["confidence"])).otherwise("-")
    line = lambda m: F.format_string("| `%s` | **%s** | %s | %s | %s |\n", m["alias"], m["concept_name"], m["concept_id"], lookup(m["alias_type"], TYPE_LABELS, m["alias_type"]), value(m))
    # an alias has one dictionary entry, so its lines are alike
    return F.concat(F.lit(TABLE_HEAD), F.array_join(F.array_distinct(F.transform(spans, line)), ""))


def rendered(annotated: DataFrame, *, text_col: str = "text", inline_links: bool = False, to: str = "annotated") -> DataFrame:
    """annotated with the column `to`: the text, its words linked if asked for, and the table; or the note that nothing matched."""
    text, spans = F.col(text_col), F.col("spans")
    body = inline(text, spans) if inline_links else text
    return annotated.withColumn(to, F.when(F.size(spans) == 0, F.concat(text, F.lit(NO_MATCH))).otherwise(F.concat(body, annotation_table(spans))))
