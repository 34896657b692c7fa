"""Token ids in binary shards with a minimal perfect hash index.

Layout of a store, a folder on any file system that pyarrow opens by URI (the shared folder here):
  shard-PPPPPP-SSSSSS.bin   the raw ids of its documents, one after another, little-endian, 2 bytes each if the vocabulary has at
                            most 65,536 ids, else 4
  shard-PPPPPP-SSSSSS.idx   magic, counts, then per document its key and its first id, then the minimal perfect hash (a bit array
                            for each level) and, per key, a fingerprint, its first document and its number of documents
  shards.man                the manifest: names, documents, ids, first and last key of the shards, in order
Documents are in ascending order of their key over all shards, so a key's shard is found by bisection of the manifest, and its place
in the shard in constant time: hash, rank, compare fingerprint. All reading goes that way: keyed access (Store, fetch) and reading
a whole store back (read_store), where each shard's keys are looked up in its hash and the ids are read where it says.

Texts are dealt by ranges of (key, hash of text) and sorted in their partition; each task streams its documents into shards of at
most SHARD_IDS ids and a document more, so memory holds a batch of texts and the index of a shard. A shard is written under a
name of its own and moved, so repeated or speculative tasks leave the same files.

The ids are those of the tokenizers library. It encodes whole words, as its own splitter makes them; words that come again are
remembered. A text with a special token's string, or
a code point that Unicode tables of different age may class differently, is encoded by the library as a whole.

Edge cases: a null or empty text has the end id only. A null key comes last and is found as None. Equal keys stand side by side, by
hash of text; their one key finds all of them, also over several shards. Other columns stay unread and may have any names. Empty tables give
no shards.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata
import uuid
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas.llm.bpe import byte_letters
from lexatlas.llm.common import columns, name, ready_python, scratch_path, staged, table, unassigned

MAGIC, MANIFEST = b"LXTOK1\0\0", "shards.man"
SHARD_IDS = 1 << 26
#: Words whose ids a worker remembers, and the longest of them.
WORDS_KEPT, WORD_MOST = 1 << 19, 32
INDEXES_KEPT = 8
#: Fixed value: how the word vocabulary splits a normalised text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLIT_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+"
#: The same over code points that most Latin texts keep to: letters, numbers and white space of Latin-1, Latin Extended-A and general punctuation.
_L, _N, _S = r"a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r" \t-\r\x85\xa0\u2000-\u200a\u2028\u2029\u202f\u205f"
SPLIT_LATIN, BEYOND_LATIN = f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+", r"[^\0-\u017f\u2000-\u206f]"
NULL_KEY = np.uint64(0xF1EA5EED0DDBA11)


class Words(dict):
    """word -> its ids by the library's model, which takes its bytes as the letters of the vocabulary; kept unless the word is longer than
    WORD_MOST or there are too many."""

    def __init__(self, tokenize, letters: dict[int, str], pack):
        self.tokenize, self.letters, self.pack = tokenize, letters, pack

    def __missing__(self, word: str) -> bytes:
        shown = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)
        ids = self.pack([t.id for t in self.tokenize(shown)])
        if len(word) <= WORD_MOST and len(self) <= WORDS_KEPT:
            self[word] = ids
        return ids


class WordEncoder:
    """The ids that the tokenizers library gives, word by word, as little-endian bytes of `width` each."""

    def __init__(self, spec: bytes):
        j = json.loads(spec)
        self.spec, self._whole = spec.decode(), None
        self.specials = [t["content"] for t in j["added_tokens"]]
        splits = [p["pattern"]["Regex"] for p in (j["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        names = [n["type"] for n in (j["normalizer"] or {}).get("normalizers", [])]
        levels = [p["type"] for p in (j["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_word = splits == [SPLIT] and levels == ["Split", "ByteLevel"] and names == ["NFC", "Replace", "Lowercase"] and not j["post_processor"]
        whole = self.whole()
        self.width, self.code = (2, "H") if whole.get_vocab_size() <= 1 << 16 else (4, "I")
        if self.by_word:
            self.normalise = whole.normalizer.normalize_str
            self.split, self.split_ascii, self.newer = regex.compile(SPLIT).findall, re.compile(SPLIT_ASCII).findall, unassigned()
            self.split_latin, self.beyond_latin = re.compile(SPLIT_LATIN).findall, re.compile(BEYOND_LATIN).search
            self.words = Words(whole.model.tokenize, {b: c for c, b in byte_letters().items()}, self.packed)
            self._whole = None  # made again for a text that needs it

    def whole(self):
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_str(self.spec)
            self._whole.no_truncation()
            self._whole.no_padding()
        return self._whole

    def packed(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if text.isascii():
            if not self.by_word or any(s in text for s in self.specials):
                return self.packed(self.whole().encode(text, add_special_tokens=False).ids)
            words = self.split_ascii(text.lower())
        else:
            if not self.by_word or self.newer(text) or any(s in text for s in self.specials):
                return self.packed(self.whole().encode(text, add_special_tokens=False).ids)
            # lower() looks at what surrounds a capital sigma, the library doesn't
            text = text.lower() if "\u03a3" not in text and unicodedata.is_normalized("NFC", text) else self.normalise(text)
            words = (self.split if self.beyond_latin(text) else self.split_latin)(text)
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        return b"".join([b"".join(map(self.words.__getitem__, words[k : k + (1 << 16)])) for k in range(0, len(words), 1 << 16)])


_encoders: dict[int, WordEncoder] = {}


def encoder(spec: bytes) -> WordEncoder:
    key = zlib.crc32(spec)
    if key not in _encoders:
        _encoders[key] = WordEncoder(spec)
    return _encoders[key]


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of 64-bit keys."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct 64-bit keys -> 0 .. n - 1, a few bits a key. Each level sets a bit for each key that is alone at its place; the others
    go on to the next. A key's number is the rank of its bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.concatenate([[0], np.cumsum(np.concatenate([np.bitwise_count(x) for x in levels] or [[0]]), dtype=np.int64)])
        self.first = np.cumsum([0, *map(len, levels)])

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 2.0) -> PerfectHash:
        levels = []
        while len(keys):
            bits = -(-max(64, int(len(keys) * room)) // 64) * 64
            at = mix(keys, len(levels)) % np.uint64(bits)
            alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[at.astype(np.int64)]]
            if len(levels) > 64:
                raise ValueError("keys aren't distinct")
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of keys; any number, or -1, for others."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for n, bits in enumerate(self.levels):
            at = mix(keys[todo], n) % np.uint64(len(bits) * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.before[self.first[n] + word] + below)[hit]
            todo = todo[~hit]
        return out


def hashed(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    """What stands for keys in the hash; a null key has a number of its own, told apart by its flag."""
    x = mix(keys.astype(np.int64).view(np.uint64), 101)
    return np.where(null, NULL_KEY, x)


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (mix(h, 202) >> np.uint64(32)).astype("<u4")


class Index:
    """The .idx file of a shard."""

    def __init__(self, keys: np.ndarray, null: np.ndarray, starts: np.ndarray, width: int, table: PerfectHash | None = None, slots: np.ndarray | None = None):
        self.keys, self.null, self.starts, self.width = keys, null, starts, width
        if table is None:
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])
            first = np.flatnonzero(new)
            h = hashed(keys[first], null[first])
            table = PerfectHash.build(h)
            slots = np.zeros((len(first), 3), "<u4")
            slots[table(h)] = np.stack([fingerprints(h), first, np.diff(np.append(first, len(keys)))], 1)
        self.table, self.slots = table, slots

    def find(self, keys: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; -1 and 0 if the shard has none."""
        h = hashed(keys, null)
        at = self.table(h)
        if not len(self.slots):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        slot = self.slots[np.maximum(at, 0)]
        ok = (at >= 0) & (slot[:, 0] == fingerprints(h))
        return np.where(ok, slot[:, 1].astype(np.int64), -1), np.where(ok, slot[:, 2].astype(np.int64), 0)

    def by_key(self) -> tuple[np.ndarray, np.ndarray]:
        """The key of each document, null or not, as the hash finds documents by their keys."""
        first, count = self.find(self.keys, self.null)
        keys, null, seen = np.zeros_like(self.keys), np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        new = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else np.zeros(0, np.int64)
        at = np.repeat(first[new], count[new]) + np.arange(count[new].sum()) - np.repeat(np.cumsum(count[new]) - count[new], count[new])
        keys[at], null[at], seen[at] = np.repeat(self.keys[new], count[new]), np.repeat(self.null[new], count[new]), True
        if (first < 0).any() or len(at) != len(seen) or not seen.all():
            raise ValueError("the hash doesn't find every document")
        return keys, null

    def to_bytes(self) -> bytes:
        levels = self.table.levels
        head = MAGIC + struct.pack("<QQII", len(self.keys), len(self.slots), self.width, len(levels)) + np.array([len(x) for x in levels], "<u8").tobytes()
        return b"".join([head, self.keys.astype("<i8").tobytes(), np.packbits(self.null, bitorder="little").tobytes(), self.starts.astype("<u8").tobytes(), *(x.astype("<u8").tobytes() for x in levels), self.slots.astype("<u4").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> Index:
        if data[:8] != MAGIC:
            raise ValueError("not an index of token shards")
        n, m, width, count = struct.unpack_from("<QQII", data, 8)
        at = 32

        def take(kind: str, k: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, kind, k, at)
            at += x.nbytes
            return x

        sizes = take("<u8", count).tolist()
        keys, null, starts = take("<i8", n), np.unpackbits(take("u1", -(-n // 8)), bitorder="little", count=n).astype(bool), take("<u8", n + 1)
        return cls(keys, null, starts, width, PerfectHash([take("<u8", k) for k in sizes]), take("<u4", 3 * m).reshape(m, 3))


class _Shard:
    """Writes one shard."""

    def __init__(self, folder: str, name: str, width: int):
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        self.name, self.width = name, width
        self.part = f"{self.path}/{name}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.path, recursive=True)
        self.out = self.fs.open_output_stream(f"{self.part}.bin")
        self.keys: list[int | None] = []
        self.starts = [0]

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.keys.append(key)
        self.starts.append(self.starts[-1] + len(ids) // self.width)

    def close(self) -> tuple:
        self.out.close()
        null = np.array([k is None for k in self.keys])
        keys = np.array([0 if k is None else k for k in self.keys], np.int64)
        with self.fs.open_output_stream(f"{self.part}.idx") as f:
            f.write(Index(keys, null, np.array(self.starts, np.uint64), self.width).to_bytes())
        for end in (".idx", ".bin"):
            self.fs.move(f"{self.part}{end}", f"{self.path}/{self.name}{end}")
        return self.name, len(self.keys), self.starts[-1], self.keys[0], self.keys[-1]


SHARDS = "name string, docs long, ids long, first_key long, last_key long"


def write_store(docs: DataFrame, spec_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 2, folder: str | None = None, shard_ids: int = SHARD_IDS) -> tuple[str, DataFrame]:
    """Write a store; its folder and the table of its shards (SHARDS)."""
    spark = docs.sparkSession
    ready_python(spark)
    folder = folder or scratch_path(spark, "tokens")
    with open(spec_path, "rb") as f:
        spec = spark.sparkContext.broadcast(f.read())  # a vocabulary, of fixed size
    rows = docs.select(F.col(name(id_col)).cast("long").alias("key"), F.col(name(text_col)).cast("string").alias("text"))
    order = [F.col("key").asc_nulls_last(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part = encoder(spec.value), TaskContext.get().partitionId()
        end = e.packed([] if end_id is None else [end_id])
        shard, done = None, []
        for b in batches:
            for key, text in zip(b.column(0), b.column(1), strict=True):
                if shard is None:
                    shard = _Shard(folder, f"shard-{part:06d}-{len(done):06d}", e.width)
                shard.add(key.as_py(), e.encode(text.as_py()) + end)
                if shard.starts[-1] >= shard_ids:
                    done.append(shard.close())
                    shard = None
        if shard is not None:
            done.append(shard.close())
        cols = list(zip(*done, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), *[pa.int64()] * 4), strict=True)], ["name", "docs", "ids", "first_key", "last_key"])

    shards = staged(rows.mapInArrow(run, SHARDS), "token-shards")

    def manifest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        part = f"{path}/{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            f.write(json.dumps([[r[c] for c in ("name", "docs", "ids", "first_key", "last_key")] for r in rows]).encode())
        fs.move(part, f"{path}/{MANIFEST}")
        yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], ["shards"])

    # a row for each shard of SHARD_IDS ids: a small table
    shards.coalesce(1).sortWithinPartitions("name").mapInArrow(manifest, "shards long").collect()
    return folder, shards


def _read(fs, path: str) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read()


def read_store(folder: str, shards: DataFrame, window: int = 1 << 22) -> DataFrame:
    """One row per document, read from the files: key, start (ids of all documents before it), n, crc32 (of the ids as 4-byte words)."""
    spark = shards.sparkSession
    ready_python(spark)
    # a row for each shard: what stands before it in the order of names, which is the order of keys
    before = F.coalesce(F.sum("ids").over(W.partitionBy(F.lit(0)).orderBy("name").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = staged(shards.select("name", before.alias("base")), "token-bases")
    n = max(1, shards.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                index = Index.from_bytes(_read(fs, f"{path}/{name}.idx"))
                keys, null = index.by_key()
                starts = index.starts.astype(np.int64)
                with fs.open_input_file(f"{path}/{name}.bin") as f:
                    k = 0
                    while k < len(starts) - 1:
                        # as many documents as fit the window, one at least
                        to = max(k + 1, int(np.searchsorted(starts, starts[k] + window, "right")) - 1)
                        f.seek(int(starts[k]) * index.width)
                        ids = np.frombuffer(f.read(int(starts[to] - starts[k]) * index.width), f"<u{index.width}").astype("<u4")
                        at = (starts[k : to + 1] - starts[k]).tolist()
                        crc = [zlib.crc32(ids[i:j]) for i, j in zip(at, at[1:], strict=False)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[k:to], mask=null[k:to]), pa.array(starts[k:to] + base), pa.array(np.diff(starts[k : to + 1])), pa.array(crc, pa.int64())], ["key", "start", "n", "crc32"]
                        )
                        k = to

    return shards.repartition(n, "name").mapInArrow(run, "key long, start long, n long, crc32 long")


class Store:
    """Keyed access to a store by its folder: get(key) gives the ids of the key's documents, a list for each document. The manifest is
    read once, the indexes of the INDEXES_KEPT shards used last are kept."""

    def __init__(self, folder: str):
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        shards = json.loads(_read(self.fs, f"{self.path}/{MANIFEST}"))
        order = lambda key: (key is None, key or 0)  # noqa: E731  nulls come last
        self.names = [s[0] for s in shards]
        self.firsts, self.lasts = [order(s[3]) for s in shards], [order(s[4]) for s in shards]
        self.index = lru_cache(INDEXES_KEPT)(lambda name: Index.from_bytes(_read(self.fs, f"{self.path}/{name}.idx")))

    def get(self, key: int | None) -> list[list[int]]:
        out, at = [], (key is None, key or 0)
        # the first shard that doesn't end before the key; those after it only if they begin with it
        for k in range(bisect_left(self.lasts, at), bisect_right(self.firsts, at)):
            index = self.index(self.names[k])
            first, count = (int(x[0]) for x in index.find(np.array([key or 0], np.int64), np.array([key is None])))
            with self.fs.open_input_file(f"{self.path}/{self.names[k]}.bin") as f:
                for d in range(first, first + count):
                    i, j = int(index.starts[d]), int(index.starts[d + 1])
                    f.seek(i * index.width)
                    out.append(np.frombuffer(f.read((j - i) * index.width), f"<u{index.width}").tolist())
        return out


def fetch(keys: DataFrame, folder: str, *, key_col: str = "key", to: str = "ids") -> DataFrame:
    """keys with the column `to`, array<array<int>>: the ids of each document of the key, none for a key that the store lacks. Equal and
    neighbouring keys are dealt to the same tasks, which so read few shards."""
    ready_python(keys.sparkSession)

    @F.pandas_udf("array<array<int>>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        store = Store(folder)
        for b in batches:
            yield pd.Series([store.get(None if k is None else int(k)) for k in b], dtype=object)

    kept = [c for c in keys.columns if c.lower() != to.lower()]
    dealt = keys.repartitionByRange(F.col(name(key_col)).asc_nulls_last())
    return dealt.select(*columns(kept), ids(F.col(name(key_col)).cast("long").cast("string")).alias(to))


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder, shards = write_store(docs, word_bpe_path(), end_id=2)
    return read_store(folder, shards).select(F.col("key").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))
