import random

import numpy as np
import pytest

from lexatlas.operators import anchors
from lexatlas.operators import annotate as an

DICT = "alias string, concept_id string, concept_name string, alias_type string, status string, confidence double"


def brute(text, words):
    return sorted((w, i, i + len(w)) for w in words for i in range(len(text)) if text.startswith(w, i))


@pytest.mark.parametrize("block", [1 << 20, 16])
def test_all_occurrences_of_aliases_of_any_length(spark, monkeypatch, block):
    rng = random.Random(block)
    words = sorted({"".join(rng.choice("ab c😀") for _ in range(rng.randint(1, 12))) for _ in range(300)} | {"aaaaaa", "aaaaaaa", " ", "数学 分析", "a" * 60})
    texts = ["".join(rng.choice("ab c😀") for _ in range(rng.randint(0, 90))) for _ in range(60)] + ["a" * 100, "数学 分析数学 分析", "", None, "a" * 100]
    monkeypatch.setattr(anchors, "BLOCK", block)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = sorted((r["doc_id"], r["alias"], r["start"], r["end"]) for r in an.matches_automaton(docs, spark.createDataFrame([(w,) for w in words], "alias string"), chunk=1).collect())
    assert got == sorted((i, *m) for i, t in enumerate(texts) if t for m in brute(t, words))


def test_a_dictionary_of_phrases_is_annotated_alike(spark):
    rng = random.Random(4)
    pick = lambda n: " ".join(rng.choice(["limit", "of", "a", "function", "`x`", "$y$", "sum"]) for _ in range(n))
    words = sorted({pick(rng.randint(1, 4)) for _ in range(80)})
    docs = spark.createDataFrame([(i % 7, pick(rng.randint(0, 40))) for i in range(60)] + [(None, None)], "doc_id int, text string")
    table = spark.createDataFrame([(w, f"C{i}", f"n{i}", "alias", "auto_mapped", 0.5) for i, w in enumerate(words)], DICT)
    got = [sorted((str(r["doc_id"]), str(r["text"]), [tuple(m) for m in r["spans"]]) for r in an.annotate(docs, table, chunk=c).collect()) for c in (1000, 3)]
    assert got[0] == got[1] and any("`x`" in m[2] for _, _, spans in got[1] for m in spans)


def shuffled(spark, texts, n):
    """Rows that texts send to the join, with a dictionary of n aliases of which few occur."""
    words = spark.range(n).selectExpr("concat('zq', lpad(cast(id as string), 9, 'w')) as alias").union(spark.createDataFrame([("limit of",)], "alias string"))
    keyed = an.keyed(texts, "text", "key").dropDuplicates(["key", "text"])
    sc = spark.sparkContext
    index = anchors.anchored(words, "alias", sc.broadcast(anchors.rarity(keyed, "text"))).cache()
    return anchors.text_grams(keyed, "key", "text", sc.broadcast(anchors.bloom(index)), [anchors.GRAM]).count()


def test_what_texts_send_does_not_grow_with_the_dictionary(spark):
    texts = spark.createDataFrame([(f"the limit of {i} is {i * i} and so on",) for i in range(300)], "text string")
    small, large = shuffled(spark, texts, 10), shuffled(spark, texts, 100_000)
    assert 300 <= small <= large < small + 300


def test_the_anchor_is_the_rarest(spark):
    texts = spark.createDataFrame([("the the the the xyzzy",)] * 5 + [("the other",)], "text string")
    n = anchors.rarity(texts, "text")
    assert n.sum() == 5 * 17 + 5
    row = anchors.anchored(spark.createDataFrame([("the xyzzy",), ("the",)], "alias string"), "alias", spark.sparkContext.broadcast(n)).collect()
    h = anchors.grams(anchors.code_points("the xyzzy"), anchors.GRAM)
    least = n[(h & np.uint64(anchors.RARITY - 1)).astype(int)]
    assert least[row[0]["off"]] == least.min() and (row[0]["gram"], row[1]["size"], row[1]["off"]) == (int(h[row[0]["off"] : row[0]["off"] + 1].view(np.int64)[0]), 3, 0)


def test_texts_that_share_a_key(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the limit of a sum"), (2, "a function and its sum"), (3, "the limit of a sum"), (4, None)], "doc_id int, text string")
    words = ["limit", "sum", "function", "a", "of a sum"]
    table = spark.createDataFrame([(w, f"C{i}", f"n{i}", "alias", "auto_mapped", 0.5) for i, w in enumerate(words)], DICT)
    rows = lambda: sorted((r["doc_id"], [tuple(m) for m in r["spans"]]) for r in an.annotate(docs, table, chunk=1).collect())
    found = lambda: sorted(map(tuple, an.matches_automaton(docs, table.select("alias"), chunk=1).collect()))
    want = rows(), found()
    monkeypatch.setattr(an, "keyed", lambda docs, text_col, key: docs.withColumn(key, an.F.when(an.F.col(text_col).isNotNull(), an.F.lit(7).cast("long"))))
    assert (rows(), found()) == want and len(want[1]) == len(set(want[1])) > 8
