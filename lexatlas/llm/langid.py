"""Language identification by bit-sliced Bloom filters over character n-grams.

The model has a table for each length of n-grams; a row of it has one bit for each language. An n-gram is hashed to HASHES rows, and
the AND of these rows is the mask of all languages whose n-gram set contains it (and, rarely, of one that doesn't), so one lookup
answers for every language. A text's n-grams are looked up whole, the bits are counted per language, and each language's count is
corrected for the false positives that the fill of its slice lets through: (hits - rate * tried) / (1 - rate). Each length counts
by its own share, longer ones more; the language of the highest total decides, ties to the smaller name. The score is its part of
all languages' totals.

Training: at most SAMPLE distinct texts with a language are read for each language, those of least hash, and read whole. Every n-gram of
these texts is set in the slice of every language that has it; nothing is chosen beforehand. Workers set the bits of their texts, and
Spark joins them by bit_or. The tables have ROWS rows whatever the input, so a model takes a fixed number of bytes per 64 languages; a
fuller table has a higher rate, which the correction takes into account.

Edge cases: a null text or one without any letter is `und` with score 0; so is every text where nothing was learned. A text that
hits no n-gram gets the language most frequent in the sample, score 0. Rows without language or text teach nothing. Other columns
may have any names. Copies get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas.llm.common import columns, name, own, ready_python, staged, table

UND = "und"
SAMPLE = 2000
LENGTHS = (1, 2, 3, 4, 5)
WEIGHTS = (0.5, 1.0, 2.0, 3.0, 3.0)
#: Rows of the table of each length, a fixed size.
ROWS = (1 << 14, 1 << 17, 1 << 19, 1 << 20, 1 << 20)
HASHES = 3
#: Rows of a table that travel to the driver as one packed block.
BLOCK_ROWS = 1 << 16
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def grams(text: str, lengths=LENGTHS, block: int = 1 << 18) -> Iterator[tuple[int, np.ndarray]]:
    """(length, 64-bit values of all n-grams of that length) of a text: letters in lower case, each run of others as one space.

    Long texts come in blocks that overlap by the longest length, so every n-gram comes once.
    """
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(letter_table()[code], code, 32).astype(np.uint64)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
    code = np.concatenate([[np.uint64(32)], code[keep], [np.uint64(32)]])
    for k in range(0, len(code), block):
        part = code[k : k + block + max(lengths) - 1]
        for n in lengths:
            m = min(block, len(code) - k) if k + block + n - 1 <= len(code) else len(part) - n + 1
            if m <= 0:
                continue
            value = np.zeros(m, np.uint64)
            for i in range(n):
                value = value * np.uint64(0x100000001B3) + part[i : i + m] + np.uint64(1)
            if n == 1:
                value = value[part[:m] != 32]  # a space alone is in every language
            yield n, value ^ (np.uint64(n) << np.uint64(56))


def slots(values: np.ndarray, rows: int) -> np.ndarray:
    """HASHES row numbers for each value; rows is a power of two."""
    x = values[None, :] * _SEEDS[:HASHES, None]
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return ((x >> np.uint64(40)) & np.uint64(rows - 1)).astype(np.int64)


def set_rows(values: np.ndarray, rows: int) -> np.ndarray:
    """The rows that hold the bits of these values, each once."""
    return np.unique(slots(values, rows))


def word_type(languages: int) -> type:
    """The smallest word that has a bit for each language, else words of 64: small tables stay in caches."""
    return np.uint8 if languages <= 8 else np.uint16 if languages <= 16 else np.uint32 if languages <= 32 else np.uint64


class Model:
    """tables: for each length its rows as an array of rows x words, a bit for each language."""

    def __init__(self, languages: list[str], usual: str, tables: list[np.ndarray], lengths: tuple[int, ...] = LENGTHS, weights: tuple[float, ...] = WEIGHTS):
        self.languages, self.usual, self.lengths, self.weights = languages, usual, tuple(lengths), tuple(weights)
        k = len(languages)
        self.tables = tables
        #: A language's part of false positives at each length: all HASHES rows of a stranger have its bit.
        self.rates = [np.array([float((t[:, j // 64] >> t.dtype.type(j % 64) & t.dtype.type(1)).mean()) for j in range(k)]) ** HASHES for t in tables]
        self.bits = np.array([[m >> j & 1 for j in range(k)] for m in range(256)]) if k <= 8 else None

    def masks(self, n: int, values: np.ndarray) -> np.ndarray:
        """The languages that contain each n-gram of length n: values x words."""
        table = self.tables[self.lengths.index(n)]
        at = slots(values, len(table))
        mask = table[at[0]]
        for row in at[1:]:
            mask = mask & table[row]
        return mask

    def hits(self, n: int, values: np.ndarray) -> np.ndarray:
        """How many of the n-grams each language contains."""
        mask = self.masks(n, values)
        if self.bits is not None:
            return np.bincount(mask[:, 0], minlength=256) @ self.bits
        return np.array([np.count_nonzero(mask[:, j // 64] & mask.dtype.type(1 << j % 64)) for j in range(len(self.languages))])

    def totals(self, text: str) -> np.ndarray:
        """Each language's weighted share of a text's n-grams, false positives taken off."""
        out, k = np.zeros(len(self.languages)), len(self.languages)
        hits, tried = {n: np.zeros(k) for n in self.lengths}, dict.fromkeys(self.lengths, 0)
        for n, values in grams(text, self.lengths):
            tried[n] += len(values)
            hits[n] += self.hits(n, values)
        for weight, rate, n in zip(self.weights, self.rates, self.lengths, strict=True):
            if tried[n]:
                out += weight * np.maximum(0, np.divide(hits[n] - rate * tried[n], 1 - rate, out=np.zeros(k), where=rate < 1)) / tried[n]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UND, 0.0
        t = self.totals(text)
        best = int(np.argmax(t))
        return (self.languages[best], float(min(1.0, t[best] / t.sum()))) if t[best] > 0 else (self.usual, 0.0)


def _bits(languages: list[str], lengths, rows):
    """The bits that a partition's texts set: length, word, row, bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = {lang: k for k, lang in enumerate(languages)}
        tables: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                k = number[lang]
                for n, values in grams(text, lengths):
                    size = rows[lengths.index(n)]
                    table = tables.setdefault((n, k // 64), np.zeros(size, np.uint64))
                    table[set_rows(values, size)] |= np.uint64(1 << k % 64)
        for (n, word), table in tables.items():
            at = np.flatnonzero(table)
            yield pd.DataFrame({"n": n, "word": word, "row": at, "bits": table[at].view(np.int64)})

    return run


def _packed(kind: type):
    """Rows of one block of a table as bytes."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        block = part["row"].iloc[0] // BLOCK_ROWS
        out = np.zeros(BLOCK_ROWS, kind)
        out[part["row"].to_numpy() - block * BLOCK_ROWS] = part["bits"].to_numpy().view(np.uint64).astype(kind)
        return pd.DataFrame({"n": [part["n"].iloc[0]], "word": [part["word"].iloc[0]], "block": [block], "data": [out.tobytes()]})

    return run


def train(rows: DataFrame, *, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, lengths=LENGTHS, weights=WEIGHTS, table_rows=ROWS) -> Model:
    """A model from rows with a language. Of each language at most `sample` distinct texts are read, by least hash."""
    spark = rows.sparkSession
    ready_python(spark)
    rows = rows.select(F.col(name(lang_col)).cast("string").alias("lang"), F.col(name(text_col)).cast("string").alias("text")).where("lang is not null and text is not null")
    rows = rows.withColumn("h", F.xxhash64("text"))
    # about a tenth more than wanted, then the bound itself on what is left
    rate = rows.groupBy("lang").agg((F.lit(1.2 * sample) / F.approx_count_distinct("h", 0.02)).alias("rate"))
    part = (F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))).alias("u")
    some = rows.join(staged(rate.coalesce(1), "lang-rates"), "lang").where(part < F.col("rate"))
    some = some.groupBy("lang", "h").agg(F.min("text").alias("text"))
    some = staged(some.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h"))).where(F.col("k") <= sample).select("lang", "text"), "lang-sample")
    sizes = {r["lang"]: r["n"] for r in some.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    languages, lengths = sorted(sizes), tuple(lengths)
    kind = word_type(len(languages))
    tables = [np.zeros((size, max(1, -(-len(languages) // 64))), kind) for size in table_rows]
    dealt = some.repartition(max(1, min(64, sum(sizes.values()) // 500)), F.xxhash64("text"))
    bits = dealt.mapInPandas(_bits(languages, lengths, tuple(table_rows)), "n int, word int, row long, bits long")
    bits = bits.groupBy("n", "word", "row").agg(F.bit_or("bits").alias("bits"))
    blocks = bits.groupBy("n", "word", F.floor(F.col("row") / BLOCK_ROWS)).applyInPandas(_packed(kind), "n int, word int, block long, data binary")
    for r in blocks.collect():  # the tables' own size, whatever the input's
        table, at = tables[lengths.index(r["n"])], r["block"] * BLOCK_ROWS
        here = table[at : at + BLOCK_ROWS, r["word"]]
        here[:] = np.frombuffer(bytes(r["data"]), kind)[: len(here)]
    return Model(languages, max(languages, key=sizes.get, default=UND), tables, lengths, weights)


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", to: str = "language") -> DataFrame:
    """docs with the column `to`: struct(lang, score)."""
    ready_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            yield pd.DataFrame([m.predict(t) for t in texts], columns=["lang", "score"])

    return docs.withColumn(to, run(F.col(name(text_col)).cast("string")))


def keep_identified(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """docs without the rows whose text is null or has no letter: the `und` ones, if anything was learned. The same columns."""
    if not model.languages:  # all is und, whatever its text
        ready_python(docs.sparkSession)

        @F.pandas_udf("boolean")
        def lettered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([has_letter(t) for t in texts], dtype=bool)

        return docs.where(lettered(F.col(name(text_col)).cast("string")))
    to = f"{own(docs)}language"
    return identify(docs, model, text_col=text_col, to=to).where(F.col(f"{to}.lang") != UND).select(*columns(docs.columns))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from training. A null id is: its fold is unknown."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")
