import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lexatlas.llm import simhash
from lexatlas.llm.components import components
from lexatlas.llm.queries import queries


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute.fingerprint(r["text"]) for r in docs]
    want = {r["doc_id"]: (f"{f:016x}", c) for r, f, c in zip(docs, prints, brute.classes(prints, [r["doc_id"] for r in docs]), strict=True)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries()["op3_simhash_dedup"](spark, sf_dir).collect()}
    assert got == want


def test_fingerprints_of_edge_cases():
    for text in (None, "", " \t\n", "one", "a b c", "A b C d", "É É É É É", "x " * 70_000, "a\x85b c", "w1 w2 w3 w4 w5 w1 w2 w3 w4 w5"):
        assert simhash.fingerprint(text) & (2**64 - 1) == brute.fingerprint(text)


@pytest.mark.parametrize("group_most", [2048, 2])
def test_links_of_dense_and_sparse_fingerprints(spark, group_most):
    rng = random.Random(group_most)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = [0, 2**64 - 1, *base]
    for b in base[:6]:
        for _ in range(60):
            prints.append(b ^ sum(1 << k for k in set(rng.choices(range(64), k=rng.randint(0, 6)))))
    prints += prints[:50]
    ids = [None if i % 50 == 0 else i for i in range(len(prints))]
    signed = [int(np.array([f], np.uint64).view(np.int64)[0]) for f in prints]
    rows = spark.createDataFrame(list(zip(ids, signed, strict=True)), "doc_id long, fp long")
    label = {r["fp"]: r["component_id"] for r in simhash.simhash_classes(rows, group_most=group_most).collect()}
    assert [label[f] for f in signed] == brute.classes(prints, ids)


def test_edge_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (None, "a b c d e f", 2), (4, "a b c d e f", 3), (4, "a b c d e f", 4), (9, "q", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == [("1", 1), ("2", 1), ("4", 4), ("4", 4), ("9", 9), ("None", 4)]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 9]
    assert simhash.near_duplicates(docs.where("false")).count() == 0 and simhash.drop_near_duplicates(docs.where("false")).count() == 0


def test_components_random(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {v: v for e in edges for v in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: find(v) for v in linked}
    assert components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).count() == 0


@pytest.mark.parametrize("most", [1, 2, 3, 4])
def test_crowded_keys_link_at_every_distance(spark, most):
    rng = random.Random(most)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(40)} | set(base)
    prints |= {(base[0] & ~0xFFFFFFFF) | (base[0] ^ bits) & 0xFFFFFFFF for bits in (0b111 << 3, 0b111 << 9, 0b1 << 20, 0b11 << 20, 0b111 << 20, 0b1111 << 20)}
    prints = sorted(prints)
    near = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= most}
    rows = spark.createDataFrame([(int(np.array([f], np.uint64).view(np.int64)[0]),) for f in prints], "fp long")
    got = {tuple(sorted((r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)))) for r in simhash.hamming_links(rows, most, 2).collect()}

    def groups(edges):
        up = {f: f for f in prints}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            up[find(a)] = find(b)
        heads = {}
        for f in prints:
            heads.setdefault(find(f), set()).add(f)
        return {frozenset(g) for g in heads.values()}

    assert got <= near and groups(got) == groups(near)
