"""Phrase collocation mining by pivot partitioning, as in MG-FSM.

Texts are cut into pieces at marks and line ends, pieces into words; nothing is counted across pieces. Pass 1 counts words, exactly.
Words have one order, from frequent to rare, and the rarest word of a phrase is its pivot. Pass 2 rewrites texts for each pivot: an
occurrence of it keeps the words beside it as far as a phrase reaches, cut off where a rarer word stands, since a phrase over that
word is another pivot's, and on the left where the pivot itself stands, since a phrase that holds the pivot twice is counted at its
first. Equal fragments of a task are merged. Fragments are routed to their pivot, where phrases that hold it are counted; no other
pivot has them, so these counts are whole. A pivot with many occurrences is dealt to several tasks by fragments, and only such
pivots' counts are added up afterwards.

The order needs the same in every task, not exact: it goes by levels of frequency, ties by the word. A sketch of fixed size (two
tables of SLOTS bytes) holds the highest level of the words that fall into a slot; a word's level is the smaller of its two slots.
Levels are never too low, so a word without a level is rarer than `least` and no phrase holds it. Crowded slots make fragments longer,
never wrong.

Cuts, scores and the rule of longer phrases are joins of the counted phrases; keys that many of them share are dealt by salts. Ranks
come from dense numbers over sampled ranges: no task holds the phrases of a language.

Edge cases: a null text is empty, a null language is `und`, as a language of that name. Empty and repeated texts count as they are. Texts of any
length are read in slices, with the words around each cut. Two languages never share counts. Only the named columns are read; others
may have any names. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.functions.numbering import dense_numbers
from lexatlas.llm.common import name, ready_python, staged, table
from lexatlas.llm.uneven import hot_keys, join_dealt

MAX_WORDS, LEAST, CONTAINED, TOP, SCALE = 3, 10, 50, 2000, 1_000_000
UND = "und"
#: Bytes of text that are cut into words at once.
SLICE = 4 << 20
#: Slots of each of the sketch's two tables, and slots that travel to the driver as one block.
SLOTS, BLOCK = 1 << 22, 1 << 16
#: Occurrences of a pivot, or parts of all words, from which it is dealt to several tasks.
HOT, HOT_PARTS = 1 << 16, 10_000
END = b"\n"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + END * 10 + b" ")
_GAP = re.compile(rb"[ \n]")


def slices(texts: list[bytes], size: int = SLICE) -> Iterator[bytes]:
    """The folded texts in slices of about this size, each text ended by END; long texts are cut between words."""
    part: list[bytes] = []
    n = 0
    for t in texts:
        t, at = t.translate(_FOLD), 0
        while len(t) - at > size and (gap := _GAP.search(t, at + size)):
            yield b"".join([*part, t[at : gap.start()]])
            part, n, at = [], 0, gap.start()
        part += [t[at:], END]
        n += len(t) - at + 1
        if n >= size:
            yield b"".join(part)
            part, n = [], 0
    yield b"".join(part)


def runs(texts: list[bytes], reach: int, size: int = SLICE) -> Iterator[tuple[list[bytes], int, int]]:
    """(words, first, last + 1): words in runs, END between pieces. Each word is in one run's own range, with `reach` words around it."""
    words: list[bytes] = []
    first = 0
    for s in slices(texts, size):
        words = words + [w for w in s.replace(END, b" \n ").split(b" ") if w]
        last = len(words) - reach
        if last > first:
            yield words, first, last
            keep = max(0, last - reach)
            words, first = words[keep:], last - keep
    yield words, first, len(words)


def by_language(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        if text:
            out[lang].append(text)
    return out


def _counted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, texts in by_language(b).items():
                n: Counter[bytes] = Counter()
                for words, first, last in runs(texts, 0, size):
                    n.update(words[first:last])
                n.pop(END, None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(n.keys(), pa.binary()), pa.array(n.values(), pa.int64())], ["lang", "word", "n"])

    return run


def corpus(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """lang, text (bytes)."""
    text, lang = F.col(name(text_col)), F.col(name(lang_col))
    return docs.select(F.coalesce(lang.cast("string"), F.lit(UND)).alias("lang"), text.cast("string").cast("binary").alias("text"))


def word_counts(texts: DataFrame, size: int = SLICE) -> DataFrame:
    """lang, word, n: every word's occurrences."""
    parts = texts.mapInArrow(_counted(size), "lang string, word binary, n long")
    return staged(parts.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n")), "phrase-words")


def level(n: Column) -> Column:
    """A quarter octave of a frequency, from 1 to 255."""
    return F.least(F.lit(255), F.lit(1) + F.floor(4 * F.log2(n))).cast("int")


def _packed(part: pd.DataFrame) -> pd.DataFrame:
    out = np.zeros(BLOCK, np.uint8)
    out[part["slot"].to_numpy() % BLOCK] = part["level"].to_numpy()
    return pd.DataFrame({"row": [part["row"].iloc[0]], "block": [part["slot"].iloc[0] // BLOCK], "data": [out.tobytes()]})


def sketch(counts: DataFrame, least: int, slots: int = SLOTS) -> np.ndarray:
    """Two tables of levels, of fixed size whatever the input. slots: a power of two, a multiple of BLOCK."""
    h = F.xxhash64("lang", "word")
    places = [F.struct(F.lit(k).alias("row"), F.shiftrightunsigned(h, 32 * k).bitwiseAND(F.lit(slots - 1)).alias("slot")) for k in (0, 1)]
    spots = counts.where(F.col("n") >= least).select(F.explode(F.array(*places)).alias("p"), level(F.col("n")).alias("level"))
    spots = spots.groupBy("p.row", "p.slot").agg(F.max("level").alias("level"))
    packed = spots.groupBy("row", F.floor(F.col("slot") / BLOCK)).applyInPandas(_packed, "row int, block long, data binary")
    out = np.zeros((2, slots), np.uint8)
    for r in packed.collect():  # 2 * SLOTS bytes at most
        out[r["row"], r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(bytes(r["data"]), np.uint8)
    return out


def levels(tables: np.ndarray, lang: str, words: list[bytes]) -> np.ndarray:
    """The level of each word; 0 if it is surely rarer than `least`. END has none."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)
    h = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    mask = np.uint64(tables.shape[1] - 1)
    out = np.minimum(tables[0][(h & mask).astype(np.int64)], tables[1][(h >> np.uint64(32) & mask).astype(np.int64)]).astype(np.int64)
    for k, w in enumerate(words[:1] if words[:1] == [END] else ()):
        out[k] = 0
    return out


def fragments_of(words: list[bytes], first: int, last: int, rank_of: np.ndarray, number: dict[bytes, int], reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct fragments of the pivots at first..last-1: a row of 2 * reach + 1 word numbers (-1: none) each, the pivot in the middle, and how
    often each occurs. rank_of: a word's place from frequent to rare, -1 for words that no phrase holds."""
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    none = np.iinfo(np.int64).max
    rank = rank_of[ids]
    rank = np.pad(np.where(rank < 0, none, rank), reach, constant_values=none)
    ids = np.pad(ids, reach, constant_values=-1)
    at = np.flatnonzero(rank[first + reach : last + reach] < none) + first + reach
    pivot = rank[at]
    row = np.full((2 * reach + 1, len(at)), -1, np.int64)
    row[reach] = ids[at]
    for side in (-1, 1):
        on = np.ones(len(at), bool)
        for k in range(1, reach + 1):
            beside = rank[at + side * k]
            on &= beside < pivot if side < 0 else beside <= pivot
            row[reach + side * k] = np.where(on, ids[at + side * k], -1)
    some = (row[reach - 1] >= 0) | (row[reach + 1] >= 0)
    row = row[:, some]
    # equal rows get equal numbers, one word after the other
    code = np.zeros(row.shape[1], np.int64)
    for column in row:
        code = pd.factorize(code * (len(number) + 1) + column + 1)[0] if len(code) else code
    count = np.bincount(code) if len(code) else np.zeros(0, np.int64)
    one = np.zeros(len(count), np.int64)
    one[code] = np.arange(len(code))
    return row[:, one], count, one


def _fragments(tables, least: int, reach: int, bound: int, size: int):
    """route (a number of language, pivot and salt), dealt (whether the pivot has several), lang, words (space-joined), before and after (how many
    of them stand around the pivot), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketched = tables.value
        for b in batches:
            for lang, texts in by_language(b).items():
                for words, first, last in runs(texts, reach, size):
                    number = {w: k for k, w in enumerate(dict.fromkeys([END, *words]))}
                    known = list(number)
                    lev = levels(sketched, lang, known)
                    rank_of = np.full(len(known), -1, np.int64)
                    order = sorted(np.flatnonzero(lev).tolist(), key=lambda k: (-lev[k], known[k]))
                    rank_of[order] = np.arange(len(order))
                    row, count, _ = fragments_of(words, first, last, rank_of, number, reach)
                    if not len(count):
                        continue
                    value = pa.array(known, pa.binary())
                    joined = pc.binary_join_element_wise(*(value.take(pa.array(c, mask=c < 0)) for c in row), pa.scalar(b" ", pa.binary()), null_handling="skip")
                    before, after = (row[:reach] >= 0).sum(0), (row[reach + 1 :] >= 0).sum(0)
                    # a pivot has fewer occurrences than the end of its level
                    parts = np.maximum(1, np.ceil(np.exp2(lev[row[reach]] / 4) / bound)).astype(np.uint64)
                    hashed = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
                    mixed = np.zeros(row.shape[1], np.uint64)
                    for c in row:
                        mixed = (mixed ^ np.where(c >= 0, hashed[c], np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
                        mixed ^= mixed >> np.uint64(29)
                    route = (hashed[row[reach]] ^ np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")))) + mixed % parts * np.uint64(0xC2B2AE3D27D4EB4F)
                    columns = [pa.array(route.view(np.int64)), pa.array(parts > 1), pa.array([lang] * len(count), pa.string()), joined, pa.array(before, pa.int32()), pa.array(after, pa.int32()), pa.array(count, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["route", "dealt", "lang", "words", "before", "after", "n"])

    return run


def phrase_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, size: int = SLICE, slots: int = SLOTS, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(words: lang, word, n; phrases: lang, phrase, size, a): occurrences of all words, and of the phrases of 2 to max_words words that
    occur `least` times or more."""
    spark = docs.sparkSession
    ready_python(spark)
    texts = corpus(docs, text_col, lang_col)
    counts = word_counts(texts, size)
    total = counts.agg(F.sum("n")).first()[0] or 0
    tables = spark.sparkContext.broadcast(sketch(counts, least, slots))
    kinds = "route long, dealt boolean, lang string, words binary, before int, after int, n long"
    found = texts.mapInArrow(_fragments(tables, least, max_words - 1, max(hot, total // HOT_PARTS), size), kinds)
    found = found.withColumn("words", F.col("words").cast("string")).repartition("route")

    def around(left: int, right: int) -> str:
        """The phrase of so many words before and after the pivot."""
        return f"if(before >= {left} and after >= {right}, substring_index(substring_index(words, ' ', before + {right + 1}), ' ', {-(left + right + 1)}), null)"

    shapes = [around(left, right) for left in range(max_words) for right in range(max_words - left) if left + right]
    mined = found.select("route", "dealt", "lang", "n", F.expr(f"explode(array({', '.join(shapes)}))").alias("phrase")).where("phrase is not null")
    # the partitioning by pivot holds: this is no shuffle
    mined = mined.groupBy("route", "dealt", "lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("dealt") | (F.col("n") >= least))
    phrases = mined.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least).withColumn("size", F.size(F.split("phrase", " ")))
    return counts, staged(phrases, "phrases")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, contained: int = CONTAINED, top: int = TOP, size: int = SLICE, slots: int = SLOTS, hot: int = HOT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases. score: floor(SCALE * a * a / (l * r)) of the cut into a first part
    (l) and a rest (r) at which it is lowest. Phrases inside a longer one that has `contained` % of their occurrences are dropped.
    Counts up to 10^15 are exact."""
    counts, phrases = phrase_counts(docs, text_col=text_col, lang_col=lang_col, max_words=max_words, least=least, size=size, slots=slots, hot=hot)
    words = F.split("phrase", " ")
    part = lambda at, n: F.array_join(F.slice(words, at + 1, n), " ")
    cut = [F.when(F.col("size") > k, F.struct(F.lit(k).alias("k"), part(0, k).alias("first"), part(k, max_words).alias("rest"))) for k in range(1, max_words)]
    cuts = staged(phrases.select("lang", "phrase", "a", F.explode(F.array(*cut)).alias("c")).where("c is not null").select("lang", "phrase", "a", "c.*"), "phrase-cuts")
    known = counts.where(F.col("n") >= least).select("lang", F.col("word").alias("part"), "n").unionByName(phrases.where(F.col("size") < max_words).select("lang", F.col("phrase").alias("part"), F.col("a").alias("n")))
    scored = cuts
    for key, to in (("first", "l"), ("rest", "r")):
        side = known.select(F.col("lang").alias(f"{to}_lang"), F.col("part").alias(f"{to}_part"), F.col("n").alias(to))
        scored = join_dealt(scored, side, {"lang": f"{to}_lang", key: f"{to}_part"}, hot_keys(cuts, ["lang", key], hot), by=["phrase"]).drop(f"{to}_lang", f"{to}_part")
    score = F.expr(f"(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * {SCALE}BD) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    scored = scored.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    scored = scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    inner = [F.when(F.col("size") >= at + n + (at == 0), part(at, n)) for n in range(2, max_words) for at in range(max_words - n + 1)]
    if inner:
        longer = phrases.select("lang", F.explode(F.array(*inner)).alias("phrase"), "a").where("phrase is not null").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        scored = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.lit(100) * F.col("longer") < F.lit(contained) * F.col("a"), F.lit(True))).drop("longer")
    placed = dense_numbers(scored, "place", "lang", F.desc("score"), F.desc("a"), "phrase")
    placed = staged(placed, "phrase-places")
    # the places of each language's best, looked up by place: no key is frequent
    first = placed.groupBy("lang").agg(F.min("place").alias("place")).join(counts.groupBy("lang").agg(F.sum("n").alias("n")), "lang")
    wanted = first.select("n", F.col("lang").alias("of"), F.posexplode(F.sequence("place", F.col("place") + top - 1))).select("n", "of", (F.col("pos") + 1).alias("rank"), F.col("col").alias("place"))
    best = placed.join(wanted, "place").where(F.col("lang") == F.col("of"))
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(table(spark, sf_dir, "documents").select("text", "lang"))
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), runs AS (
  SELECT lang, 1 AS size, unnest(w) AS p FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
), f AS MATERIALIZED (SELECT lang, size, p, count(*) AS a FROM runs GROUP BY lang, size, p
), total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), c AS MATERIALIZED (SELECT lang, size, p, a, string_split(p, ' ') AS w FROM f WHERE size > 1 AND a >= 10
), cut AS (
  SELECT lang, p, a, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c UNION ALL SELECT lang, p, a, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE size = 3
), best AS (
  SELECT cut.*, l.a AS l, r.a AS r, (1000000 * cut.a::HUGEINT * cut.a) // (l.a::HUGEINT * r.a) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.p = x JOIN f r ON r.lang = cut.lang AND r.p = y
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.p ORDER BY score, k) = 1
), longer AS (
  SELECT lang, q, max(a) AS a FROM (SELECT lang, w[1] || ' ' || w[2] AS q, a FROM c WHERE size = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE size = 3) GROUP BY lang, q
), kept AS (SELECT b.* FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.q = b.p WHERE x.a IS NULL OR 100 * x.a < 50 * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score::BIGINT AS score
FROM kept k JOIN total t ON t.lang = k.lang QUALIFY rank <= 2000
"""
