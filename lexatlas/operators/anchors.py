"""An anchor index: a dictionary of any size meets texts without a copy of a text for each part of the dictionary.

Every alias is keyed by one of its character n-grams, the rarest in the texts: its anchor. An alias that isn't longer than n is its own anchor.
A Bloom filter of all anchors, BITS bits whatever the dictionary, goes to every worker. Texts are dealt to parts of PART code points, and a part
tells, once each, those of its n-grams that pass the filter; these rows meet the anchors in a join, which gives each part the entries that it may
hold: a dictionary of its own, laid down in a folder of its own, and texts meet it where they are read. What is shuffled grows with the different
words of the parts, not with texts or places in them, nor with dictionary x texts.

Rarity is counted over all texts in a table of RARITY slots; slots that are shared make anchors less rare, never results wrong.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexatlas.functions.numbering import ROW_BITS
from lexatlas.scratch import laid_in, scratch_path, staged

#: Length of anchors, and of those of the index of whole words: most aliases are their own anchors there, so a part gets hardly any that it doesn't hold.
GRAM, WHOLE = 5, 16
#: Code points of a part at most, where there are enough of them for all cores, and at least; a part is put together of pieces of PIECE.
PART, LEAST, PIECE = 1 << 25, 1 << 20, 1 << 20
RARITY, BITS = 1 << 16, 1 << 26
#: Code points of a text that are hashed at once, and rows of texts that are worked on at once.
BLOCK, ROWS = 1 << 16, 200


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def sized_grams(code: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(n, a 64-bit number for each n-gram of code points, by its place) for ascending sizes; each goes on from the one before."""
    value = np.zeros(len(code), np.uint64)
    done = 0
    for n in sizes:
        m = max(0, len(code) - n + 1)
        value = value[:m]
        for i in range(done, n):
            value *= np.uint64(0x100000001B3)
            value += code[i : i + m]
            value += np.uint64(1)
        done = n
        h = value + np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        yield n, h


def grams(code: np.ndarray, n: int) -> np.ndarray:
    return next(sized_grams(code, [n]))[1]


def whole_grams(aliases: list[str]) -> np.ndarray:
    """Of each alias the number of all of it; aliases of a length are hashed together."""
    size = np.array([len(a) for a in aliases], np.int64)
    out = np.zeros(len(aliases), np.uint64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        out[at] = grams(code_points("".join(aliases[i] for i in at)), int(n))[::n]
    return out


def blocks(text: str, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(n, numbers) of a text's n-grams of ascending sizes, in blocks."""
    for at in range(0, len(text) - sizes[0] + 1, BLOCK):
        code = code_points(text[at : at + BLOCK + sizes[-1] - 1])
        for n, h in sized_grams(code, sizes):
            yield n, h[:BLOCK]


def rarity(texts: DataFrame, text_col: str, size: int = GRAM) -> np.ndarray:
    """How often n-grams of length `size` occur, by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(RARITY, np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                for _, h in blocks(text, [size]) if text else ():
                    n += np.bincount((h & np.uint64(RARITY - 1)).astype(np.int64), minlength=RARITY)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], ["slot", "n"])

    out = np.zeros(RARITY, np.int64)
    seen = texts.select(text_col).mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # RARITY rows at most
    out[seen["slot"].to_numpy()] = seen["n"].to_numpy()
    return out


def anchored(entries: DataFrame, alias_col: str, counts, longest: int = GRAM) -> DataFrame:
    """entries with gram, off and size: the anchor of each alias, where in it it begins, and its length. counts: a broadcast of rarity()."""

    @F.pandas_udf("gram long, off int, size int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        n = counts.value
        for aliases in batches:
            out = pd.DataFrame({"gram": whole_grams([a[:longest] for a in aliases]).view(np.int64), "off": 0, "size": aliases.str.len().clip(upper=longest)})
            for i in np.flatnonzero(aliases.str.len() > longest):
                h = grams(code_points(aliases.iloc[i]), longest)
                k = int(np.lexsort((h, n[(h & np.uint64(RARITY - 1)).astype(np.int64)]))[0])
                out.loc[i, ["gram", "off"]] = int(h[k : k + 1].view(np.int64)[0]), k
            yield out

    return entries.withColumn("__anchor", run(F.col(alias_col))).select(*entries.columns, "__anchor.*")


def bloom(anchors: DataFrame) -> np.ndarray:
    """BITS bits in words of 64; an anchor sets two of them."""
    place = [F.shiftrightunsigned("gram", 32 * k).bitwiseAND(F.lit(BITS - 1)) for k in (0, 1)]
    bits = anchors.select(F.explode(F.array(*place)).alias("p")).select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
    set_ = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # BITS / 64 rows at most
    out = np.zeros(BITS // 64, np.uint64)
    out[set_["word"].to_numpy()] = set_["bits"].to_numpy().view(np.uint64)
    return out


def passed(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Those of h that pass."""
    for k in (0, 1):
        p = h >> np.uint64(32 * k) & np.uint64(BITS - 1)
        h = h[(filter_[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)]
    return h


def text_grams(texts: DataFrame, key: str, text_col: str, filter_, sizes: list[int]) -> DataFrame:
    """gram, key: the n-grams of a key's texts that pass the filter (a broadcast of bloom()), once for texts of a key that lie together. Texts of a
    key are hashed as one, so a few n-grams run over their ends; what they ask for isn't in the texts and isn't found there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, told = filter_.value, {}
        for b in batches:
            together, before, told = defaultdict(list), told, {}
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text:
                    together[k].append(text)
            for k, some in together.items():
                text = "\n".join(some)
                seen = [np.unique(passed(known, h)) for _, h in blocks(text, sizes)]
                if seen:
                    h = np.unique(np.concatenate(seen))
                    if k in before:
                        h = h[~np.isin(h, before[k])]
                    told[k] = np.concatenate([h, before[k]]) if k in before else h
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), k, np.int64))], ["gram", "key"])

    return texts.select(F.col(key).cast("long"), text_col).mapInArrow(run, "gram long, key long")


def parts(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """docs, laid down with `__part`, from 0, and how many parts there are: texts that lie together, whatever their ids are, so that no frequent
    text or id makes a large part."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, before = TaskContext.get().partitionId() << ROW_BITS, 0
        for b in batches:
            size = pc.fill_null(pc.utf8_length(b.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = before + np.cumsum(size) - size
            before += int(size.sum())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first + at // PIECE), pa.array(size)], [*names, "__piece", "__size"])

    laid = staged(docs.mapInArrow(run, _with(docs.schema)), "parts")
    sizes = laid.groupBy("__piece").agg(F.sum("__size").alias("__size"))
    everything = W.partitionBy(F.lit(0))
    most = F.least(F.lit(PART), F.greatest(F.lit(LEAST), F.ceil(F.sum("__size").over(everything) / docs.sparkSession.sparkContext.defaultParallelism)))
    before = F.sum("__size").over(everything.orderBy("__piece")) - F.col("__size")
    dealt = staged(sizes.select("__piece", F.floor(before / most).cast("long").alias("__part")), "dealt")  # a row for each piece
    n = dealt.agg(F.max("__part")).first()[0]
    return laid.drop("__size").join(F.broadcast(dealt), "__piece").select(*names, "__part"), 1 if n is None else n + 1


def _with(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("__piece", LongType()), StructField("__size", LongType())])


def dictionaries(texts: DataFrame, entries: DataFrame, *, text_col: str, alias_col: str = "alias") -> DataFrame:
    """`__part` and entries: for each part those that its texts may hold. texts: of parts(); entries: laid down, distinct non-empty aliases."""
    sc = texts.sparkSession.sparkContext
    whole = entries.where(F.char_length(alias_col) > WHOLE).isEmpty()
    counts = np.zeros(RARITY, np.int64) if whole else rarity(texts, text_col, WHOLE)
    index = staged(anchored(entries, alias_col, sc.broadcast(counts), WHOLE), "anchors")
    sizes = sorted(r["size"] for r in index.select("size").distinct().collect())  # WHOLE rows at most
    # dealt by n-gram alone, as the join needs them, so that they are shuffled once
    asked = text_grams(texts, "__part", text_col, sc.broadcast(bloom(index)), sizes).repartition("gram").distinct()
    return asked.join(index, "gram").select(F.col("key").alias("__part"), *entries.columns)


def met(texts: DataFrame, n: int, own: DataFrame, work, schema) -> DataFrame:
    """The rows of work(entries)(rows) -> a record batch. entries: a part's own, a struct array; rows: some of its texts' rows, one too. The parts'
    entries are laid down, a folder for each part; texts stay where they are read, and a task holds one part's entries and a batch of its texts.
    texts, n: of parts(); own: of dictionaries()."""
    names = [c for c in texts.columns if c != "__part"]
    folder, shape = scratch_path(texts.sparkSession, "own"), own.drop("__part").limit(0).toArrow().schema
    own.repartition(n, "__part").write.partitionBy("__part").option("compression", "zstd").parquet(folder)

    def entries(part: int) -> pa.StructArray:
        rows = [t.select(shape.names).cast(shape) for t in laid_in(f"{folder}/__part={part}")]
        found = pa.concat_tables([shape.empty_table(), *rows]).combine_chunks()
        return pa.StructArray.from_arrays([c.combine_chunks() for c in found.columns], shape.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ready = None, None
        for b in batches:
            at = b.column(0).to_numpy()
            cuts = [0, *(1 + np.flatnonzero(at[1:] != at[:-1])).tolist(), len(at)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if at[i] != part:
                    part, ready = at[i], None
                    ready = work(entries(part))
                for k in range(i, j, ROWS):
                    yield ready(pa.StructArray.from_arrays(b.slice(k, min(j - k, ROWS)).columns[1:], names))

    return texts.select("__part", *names).mapInArrow(run, schema)
