import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lexatlas.llm import tokenbin as tb
from lexatlas.llm.queries import queries


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_whole_table(spark, sf_dir):
    library, at = Tokenizer.from_file(tb.word_bpe_path()), 0
    got = {r["doc_id"]: r for r in queries()["op4_token_store"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        r = got[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)


def test_encoder_equals_the_library():
    with open(tb.word_bpe_path(), "rb") as f:
        e = tb.WordEncoder(f.read())
    assert e.by_word
    library = Tokenizer.from_file(tb.word_bpe_path())
    texts = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} X{chr(c)}" for c in range(k, k + 32) if not 0xD800 <= c < 0xE000) for k in range(0, 0x110000, 32)]
    texts += ["", " ", "don't DON'T 12ab", "ΣΑΣ σας İ", "é é", "<|endoftext|> x <|startoftext|>", "x" * 100_000, "'" * 50 + "s", "\x00\x1c\x85\xa0 a"]
    for t, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(e.encode(t), "<u2").tolist() == want.ids, t[:60]


def test_store_and_keyed_access(spark):
    rows = [(5, "five a"), (None, "n"), (3, None), (5, "five b"), (-2, ""), (9, "x " * 50), (None, "m"), (0, "zero"), (5, "five a")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, key int")
    folder, shards = tb.write_store(df, tb.word_bpe_path(), shard_ids=3)
    library = Tokenizer.from_file(tb.word_bpe_path())
    want: dict = {}
    for k, t in rows:
        want.setdefault(k, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    store = tb.Store(folder)
    assert len(store.names) == shards.count() > 3
    for k, lists in want.items():
        assert sorted(store.get(k)) == sorted(lists)
    assert store.get(77) == store.get(-9) == []
    asked = spark.createDataFrame([(k, "x") for k in [*want, 77, 5]], "`a key` long, ids string")
    for r in tb.fetch(asked, folder, key_col="a key").collect():
        assert sorted(r["ids"]) == sorted(want.get(r["a key"], []))
    assert tb.fetch(asked.where("false"), folder, key_col="a key").count() == 0
    read = sorted(tb.read_store(folder, shards).collect(), key=lambda r: r["start"])
    assert [r["key"] for r in read] == [-2, 0, 3, 5, 5, 5, 9, None, None]
    assert [r["start"] for r in read] == [0, *np.cumsum([r["n"] for r in read])[:-1]]
    assert sorted((str(r["key"]), r["crc32"]) for r in read) == sorted((str(k), crc(x)) for k, v in want.items() for x in v)


def test_empty_table(spark):
    folder, shards = tb.write_store(spark.createDataFrame([], "doc_id long, text string"), tb.word_bpe_path())
    assert tb.Store(folder).get(1) == [] and shards.count() == 0 and tb.read_store(folder, shards).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 65, 100_000):
        keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        h = tb.PerfectHash.build(keys)
        assert sorted(h(keys).tolist()) == list(range(len(keys)))
    keys = np.arange(50_000, dtype=np.int64)
    index = tb.Index.from_bytes(tb.Index(keys, np.zeros(len(keys), bool), np.arange(len(keys) + 1), 2).to_bytes())
    first, count = index.find(keys, np.zeros(len(keys), bool))
    assert (first == keys).all() and (count == 1).all() and (index.by_key()[0] == keys).all()
    several = tb.Index(np.array([1, 1, 2, 0, 0]), np.array([False] * 3 + [True] * 2), np.arange(6), 2)
    assert several.by_key()[0].tolist() == [1, 1, 2, 0, 0] and several.by_key()[1].tolist() == [False] * 3 + [True] * 2
    several.slots[0, 0] ^= 1  # a broken fingerprint is noticed
    with pytest.raises(ValueError):
        several.by_key()
    strangers = keys + 10_000_000
    assert (index.find(strangers, np.zeros(len(keys), bool))[1] > 0).sum() == 0


def test_latin_texts_are_split_by_the_plain_pattern(monkeypatch):
    """As the library does, over all code points of the pattern beside each other (op4: CPU seconds)."""
    with open(tb.word_bpe_path(), "rb") as f:
        e = tb.WordEncoder(f.read())
    some = [chr(c) for r in (range(0x180), range(0x2000, 0x2070)) for c in r]
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(some, 300)) for _ in range(400)] + ["".join(rng.choice(list("é'sStTlLß 1²“  ª"), 60)) for _ in range(400)]
    texts = [t for t in texts if t.lower().isascii() or not e.beyond_latin(t.lower())]
    assert all(e.split_latin(t.lower()) == e.split(t.lower()) for t in texts) and len(texts) > 400
    monkeypatch.setattr(e, "split", None)
    monkeypatch.setattr(tb, "WORDS_KEPT", 500)
    for t, want in zip(texts, Tokenizer.from_file(tb.word_bpe_path()).encode_batch(texts, add_special_tokens=False), strict=True):
        assert e.newer(t) or np.frombuffer(e.encode(t), "<u2").tolist() == want.ids
        assert len(e.words) <= 501
