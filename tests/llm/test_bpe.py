import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexatlas.llm import bpe
from lexatlas.llm.queries import queries


@pytest.fixture(scope="module")
def both():
    with open(bpe.byte_bpe_path(), "rb") as f:
        return bpe.Codec(f.read()), Tokenizer.from_file(bpe.byte_bpe_path())


def same(both, texts):
    codec, library = both
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = codec.encode(t)
        assert ids == e.ids, t[:80]
        assert codec.decode(ids) == library.decode(e.ids, skip_special_tokens=False)


def test_whole_table(spark, sf_dir, both):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries()["op9_bpe_round_trip"](spark, sf_dir).collect():
        ids = both[1].encode(texts[r["doc_id"]], add_special_tokens=False).ids
        back = both[1].decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_every_code_point(both):
    same(both, ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} x" for c in range(k, k + 64) if not 0xD800 <= c < 0xE000) for k in range(0, 0x110000, 64)])


def test_random_and_odd_texts(both):
    rng = random.Random(1)
    same(both, ["".join(rng.choice("abcdefghijklmnop  'sted\n\t0123.,!-éß漢😀ABT") for _ in range(rng.randint(0, 60))) for _ in range(3000)])
    same(both, ["".join(rng.choice("aAe- _=") for _ in range(rng.randint(0, 60))) for _ in range(3000)])
    same(both, ["".join(rng.choice(["<|endoftext|>", "a", " ", "<|", "\n", "  "]) for _ in range(12)) for _ in range(500)])
    same(both, ["", "a" * 5000, "ab" * 5000, " " * 3000, "=-" * 3000, "<|endoftext|>", "x" * 200_000])


def naive(word, ranks):
    """Merging by rank, pair after pair."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: (ranks.get((parts[i], parts[i + 1]), 1 << 60), i))
        pair = (parts[best], parts[best + 1])
        if pair not in ranks:
            break
        out, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                out.append(parts[i] + parts[i + 1])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


def test_automata_of_random_merges():
    """Small alphabets make overlapping merges and merges that never apply."""
    for seed in range(60):
        rng = random.Random(seed)
        labels, merges = [bytes([b]) for b in b"abc"], []
        for _ in range(25):
            u, v = rng.randrange(len(labels)), rng.randrange(len(labels))
            if labels[u] + labels[v] not in labels:
                labels.append(labels[u] + labels[v])
                merges.append((u, v, len(labels) - 1))
        ranks = {(labels[u], labels[v]): k for k, (u, v, _) in enumerate(merges)}
        a = bpe.Automaton(labels, merges)
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            assert [labels[t] for t in a.path(word)] == naive(word, ranks)


def textbook(labels, merges):
    """The construction with whole tables: (start, state -> label -> state)."""
    arcs, target = {0: {t: 0 for t, x in enumerate(labels) if len(x) == 1}}, {}
    for u, v, uv in merges:
        for q in {to for row in arcs.values() for t, to in row.items() if t == u}:
            if v not in arcs[q]:
                continue
            copy, to = len(arcs), arcs[q][v]
            before = [s for s, row in arcs.items() if row.get(u) == q]
            arcs[copy] = {t: x for t, x in arcs[q].items() if t != v}
            if q in before and u != v:
                before.append(copy)
            for s in before:
                arcs[s][u] = copy
                arcs[s][uv] = to
    return arcs


def test_states_of_a_small_vocabulary():
    """Merges ab, ba, aba (ab + a): the states and arcs by hand, and sequences of up to four labels against whole tables."""
    labels, merges = [b"a", b"b", b"ab", b"ba", b"aba"], [(0, 1, 2), (1, 0, 3), (2, 0, 4)]
    a = bpe.Automaton(labels, merges)
    arcs = lambda q: {labels[t].decode() for t in range(5) if a.row(q)[t >> 3] >> (t & 7) & 1}
    assert a.base == [-1, 0, 0, 0] and [labels[t].decode() for t in a.lost[1:]] == ["b", "a", "a"]
    assert arcs(0) == {"a", "b", "ab", "ba", "aba"} and arcs(a.target[0]) == {"a", "ab", "aba"} and arcs(a.target[1]) == {"b", "ab", "ba", "aba"}
    assert [a.has(q, t) for q in range(4) for t in range(5)] == [bool(a.row(q)[t >> 3] >> (t & 7) & 1) for q in range(4) for t in range(5)]


def test_states_equal_the_textbook_construction():
    from itertools import product

    for seed in range(40):
        rng = random.Random(seed)
        labels, merges = [bytes([b]) for b in b"ab"], []
        for _ in range(8):
            u, v = rng.randrange(len(labels)), rng.randrange(len(labels))
            if labels[u] + labels[v] not in labels:
                labels.append(labels[u] + labels[v])
                merges.append((u, v, len(labels) - 1))
        a, arcs = bpe.Automaton(labels, merges), textbook(labels, merges)
        for sequence in product(range(len(labels)), repeat=3):
            mine, theirs = 0, 0
            for t in sequence:
                if mine >= 0:
                    mine = a.target[t] if a.row(mine)[t >> 3] >> (t & 7) & 1 else -1
                if theirs >= 0:
                    theirs = arcs[theirs].get(t, -1)
            assert (mine >= 0) == (theirs >= 0), (seed, sequence)


def test_rows_that_are_made_again(both, monkeypatch):
    monkeypatch.setattr(bpe, "ROWS_KEPT", 3)
    with open(bpe.byte_bpe_path(), "rb") as f:
        same((bpe.Codec(f.read()), both[1]), ["The quick brown fox, jumping over 12 lazy dogs' heads"])


def test_encode_and_decode_columns(spark):
    df = spark.createDataFrame([(1, "héllo <|endoftext|> wörld"), (2, None), (3, "")], "i int, `the.text` string")
    d = bpe.bpe_decode(bpe.bpe_encode(df, bpe.byte_bpe_path(), text_col="the.text"), bpe.byte_bpe_path(), to="back")
    assert {r["i"]: r["back"] for r in d.collect()} == {1: "héllo <|endoftext|> wörld", 2: "", 3: ""}
    assert bpe.bpe_encode(df.where("false"), bpe.byte_bpe_path(), text_col="the.text").count() == 0
    odd = spark.createDataFrame([([220, 158],), (None,)], "ids array<int>")
    assert {r["text"] for r in bpe.bpe_decode(odd, bpe.byte_bpe_path()).collect()} == {None, bpe.codec(open(bpe.byte_bpe_path(), "rb").read()).decode([220, 158])}
    rows = bpe.bpe_round_trip(df, bpe.byte_bpe_path(), text_col="the.text").select("i", F.col("bpe.same").alias("same")).collect()
    assert all(r["same"] for r in rows)
