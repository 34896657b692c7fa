"""Byte-level BPE by a tokenization automaton.

The automaton starts with one state that loops on every byte. Each merge (u, v), in order, applies a merge gadget to it: the state
that u leads to is copied without its v arc and the arcs u are redirected to the copy, so v can't follow u any more; and wherever u
was possible, an arc labelled uv leads to where v led before. After all merges the automaton is deterministic and accepts exactly the
token sequences that BPE makes (Berglund, Martens and van der Merwe, 2024, show the construction). As gadgets redirect all arcs of a
label alike, a label has one target state, and a state is known by the arcs that it has.

States share their arcs with the state that they were copied from: a state stores its base and the arc it lost, and an arc that is
made later is there where the arc of its left part is. States that come from copying for the same label are a family, which keeps its
lost arcs in one table by label and step. When a state is first visited, its row of the transition table is made from these: a bit for
each label. Rows are kept, ROWS_KEPT of them, a few kilobytes each; the whole table of 50,000 states would take 300 MB a worker.

A pre-split word is encoded by following byte transitions of the label trie and, where a label ends, the label's bit in the row of
the state that the word has reached: each prefix of a word has one accepted path, whose last arc is stored per position. Decoding
emits the labels of the arcs.

Edge cases: a null text is empty and has no ids. A special token's string in a text is its id, as in the tokenizers library.
Very long words take time in proportion to their length. Bytes that are no UTF-8 when decoded become U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.llm.common import name, ready_python, table, unassigned

#: Fixed value: how byte-level BPE splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a worker remembers, and rows of the transition table.
WORDS_KEPT, ROWS_KEPT = 1 << 19, 1 << 14
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary of this kind."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Automaton:
    """The compiled merges. labels: bytes by token id; target: the state that the arcs of each label lead to."""

    def __init__(self, labels: list[bytes], merges: Iterable[tuple[int, int, int]]):
        n = len(labels)
        self.labels, self.left, self.made, self.target = labels, [-1] * n, [0] * n, [0] * n
        self.arcless = {t for t, label in enumerate(labels) if not label}
        #: By state: the state it was copied from, the arc that it lost, the step, and its family. State 0 is the start.
        self.base, self.lost, self.born, self.family = [-1], [-1], [0], [-1]
        #: By family, which is the label that its first state was copied for: the state before, and the step of each lost arc.
        self.origin: dict[int, int] = {}
        self.losses: dict[int, dict[int, int]] = {}
        for step, (u, v, uv) in enumerate(merges, 1):
            self._gadget(step, u, v, uv)
        self._levels = self._by_depth()
        self.rows: dict[int, bytes] = {}
        self.next: dict[int, int] = {}
        self.accept = [-1]
        for t, label in enumerate(labels):
            if t not in self.arcless:
                s = 0
                for b in label:
                    to = self.next.get(s << 8 | b)
                    if to is None:
                        to = self.next[s << 8 | b] = len(self.accept)
                        self.accept.append(-1)
                    s = to
                self.accept[s] = t

    def _gadget(self, step: int, u: int, v: int, uv: int) -> None:
        if self.left[uv] >= 0:
            raise ValueError("a token is made by two merges")
        at = self.target[u]
        self.left[uv], self.made[uv] = u, step
        if u in self.arcless or v in self.arcless or not self.has(at, v):
            self.arcless.add(uv)  # v never follows u, so nothing changes
            return
        self.target[uv] = self.target[v]
        self.target[u] = len(self.base)
        self.base.append(at)
        self.lost.append(v)
        self.born.append(step)
        self.family.append(u)
        if self.family[at] != u:
            self.origin[u], self.losses[u] = at, {}
        self.losses[u][v] = step

    def _losses(self, state: int) -> Iterator[tuple[dict[int, int], int]]:
        """The families that a state comes from: the steps of their lost arcs, and the last step that counts."""
        while state > 0:
            family = self.family[state]
            yield self.losses[family], self.born[state]
            state = self.origin[family]

    def has(self, state: int, label: int) -> bool:
        """Whether a state has an arc: neither it nor an arc of its left parts, before that made the next one, was lost."""
        for losses, until in self._losses(state):
            x, made = label, NEVER
            while x >= 0:
                at = losses.get(x)
                if at is not None and at <= until and at <= made:
                    return False
                made, x = self.made[x], self.left[x]
        return True

    def _by_depth(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Labels with arcs by how often a left part has a left part: (labels, left parts, steps)."""
        depth, levels = [0] * len(self.labels), {}
        for t in sorted(range(len(self.labels)), key=self.made.__getitem__):
            if self.left[t] >= 0:
                depth[t] = depth[self.left[t]] + 1
            if t not in self.arcless:
                levels.setdefault(depth[t], []).append(t)
        return [tuple(np.array(x) for x in (ts, [self.left[t] for t in ts], [self.made[t] for t in ts])) for _, ts in sorted(levels.items())]

    def row(self, state: int) -> bytes:
        """A state's row of the transition table: the bit of each label whose arc it has."""
        row = self.rows.get(state)
        if row is None:
            n = len(self.labels)
            gone = np.full(n, NEVER)
            for losses, until in self._losses(state):
                labels, steps = (np.fromiter(x, np.int64, len(losses)) for x in (losses.keys(), losses.values()))
                counts = steps <= until
                gone[labels[counts]] = np.minimum(gone[labels[counts]], steps[counts])
            came = np.zeros(n, bool)
            for t, left, made in self._levels:
                came[t] = (left < 0) | came[left] & (gone[left] > made)
            if len(self.rows) >= ROWS_KEPT:
                self.rows.clear()
            row = self.rows[state] = np.packbits(came & (gone == NEVER), bitorder="little").tobytes()
        return row

    def path(self, word: bytes) -> tuple[int, ...]:
        """The labels of the one accepted path that spells word."""
        n, go, accept, target, rows, make = len(word), self.next, self.accept, self.target, self.rows, self.row
        last = [-1] * (n + 1)
        for i in range(n):
            state = target[last[i]] if i else 0
            row = rows.get(state) or make(state)
            s = 0
            for j in range(i, n):
                s = go.get(s << 8 | word[j], -1)
                if s < 0:
                    break
                t = accept[s]
                if t >= 0 and row[t >> 3] >> (t & 7) & 1 and last[j + 1] < 0:
                    last[j + 1] = t
            if last[i + 1] < 0:
                raise ValueError("the vocabulary lacks a byte")
        out, labels = [], self.labels
        while n:
            out.append(last[n])
            n -= len(labels[last[n]])
        return tuple(out[::-1])


class Codec:
    """Encodes and decodes texts as the tokenizers library does with the same file (no added special tokens)."""

    def __init__(self, spec: str | bytes):
        j = json.loads(spec)
        model = j["model"]
        if model["type"] != "BPE" or j["pre_tokenizer"]["type"] != "ByteLevel" or j["pre_tokenizer"]["add_prefix_space"] or j["normalizer"]:
            raise ValueError("a byte-level BPE without normalizer and prefix space is needed")
        letters, ids = byte_letters(), model["vocab"]
        self.specials = {t["content"]: t["id"] for t in j["added_tokens"]}
        size = 1 + max([*ids.values(), *self.specials.values()])
        self.labels = [b""] * size
        for token, i in ids.items():
            self.labels[i] = bytes(letters[c] for c in token)
        inner = [*self.labels]
        for token, i in self.specials.items():
            self.labels[i], inner[i] = token.encode(), b""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.automaton = Automaton(inner, ((ids[a], ids[b], ids[a + b]) for a, b in pairs))
        self.split, self.newer = regex.compile(SPLIT).findall, unassigned()
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.words: dict[str, tuple[int, ...]] = {}
        self.decimal = [str(i) for i in range(size)]

    def _word(self, w: str) -> tuple[int, ...]:
        ids = self.automaton.path(w.encode())
        if len(self.words) >= WORDS_KEPT:
            self.words.clear()
        if len(w) <= 64:
            self.words[w] = ids
        return ids

    def _plain(self, text: str) -> Iterator[tuple[int, ...]]:
        known, make = self.words.get, self._word
        if not text.isascii() and self.newer(text):
            from tokenizers.pre_tokenizers import ByteLevel

            ends = [0, *(e for _, (_, e) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text))]
            return (known(w) or make(w) for w in (text[i:j] for i, j in zip(ends, ends[1:], strict=False)))
        return (known(w) or make(w) for w in self.split(text))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.special is None or not any(s in text for s in self.specials):
            return list(chain.from_iterable(self._plain(text)))
        out: list[int] = []
        for piece in self.special.split(text):
            if piece in self.specials:
                out.append(self.specials[piece])
            elif piece:
                out.extend(chain.from_iterable(self._plain(piece)))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        labels = self.labels
        return b"".join([labels[i] for i in ids]).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(spec: bytes) -> Codec:
    """The compiled file, once a process."""
    key = hashlib.sha256(spec).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(spec)
    return _codecs[key]


def _spec(spark: SparkSession, path: str):
    """The vocabulary file, read on the driver; its size is fixed, so workers get it whole."""
    ready_python(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def bpe_encode(docs: DataFrame, path: str, *, text_col: str = "text", to: str = "ids") -> DataFrame:
    """docs with the column `to`: the ids of each text, array<int>."""
    spec = _spec(docs.sparkSession, path)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(spec.value)
        for texts in batches:
            yield pd.Series([c.encode(t) for t in texts], dtype=object)

    return docs.withColumn(to, run(F.col(name(text_col)).cast("string")))


def bpe_decode(rows: DataFrame, path: str, *, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """rows with the column `to`: the text that the ids spell; null ids give null."""
    spec = _spec(rows.sparkSession, path)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(spec.value)
        for ids in batches:
            yield pd.Series([None if x is None else c.decode(x) for x in ids], dtype=object)

    return rows.withColumn(to, run(F.col(name(ids_col))))


def bpe_round_trip(docs: DataFrame, path: str, *, text_col: str = "text", to: str = "bpe") -> DataFrame:
    """docs with the column `to`: struct(ids, same): the ids, and whether they decode to the text again. One worker does both, so
    that no second one holds the vocabulary."""
    spec = _spec(docs.sparkSession, path)

    @F.pandas_udf("ids array<int>, same boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(spec.value)
        for texts in batches:
            ids = [c.encode(t) for t in texts]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "same": [c.decode(i) == (t or "") for i, t in zip(ids, texts, strict=True)]})

    return docs.withColumn(to, run(F.col(name(text_col)).cast("string")))


def bpe_digests(docs: DataFrame, path: str, *, text_col: str = "text", to: str = "bpe") -> DataFrame:
    """docs with the column `to`: struct(n_tokens, ids_sha256, decoded_sha256), from ids encoded and decoded in one pass."""
    spec = _spec(docs.sparkSession, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(spec.value)
        sha, decimal = hashlib.sha256, c.decimal
        for texts in batches:
            rows = []
            for t in texts:
                ids = c.encode(t)
                rows.append((len(ids), sha(",".join([decimal[i] for i in ids]).encode()).hexdigest(), sha(c.decode(ids).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(to, run(F.col(name(text_col)).cast("string")))


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs, byte_bpe_path()).select("doc_id", "bpe.*")
