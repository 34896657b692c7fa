import re
import zlib

import brute
import numpy as np
import pytest

from lexatlas.llm import langid
from lexatlas.llm.queries import queries


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries()["op10_language_id"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)
    by_text: dict = {}
    for r in got:
        by_text.setdefault(docs[r["doc_id"]]["text"], set()).add((r["lang_pred"], r["score"]))
    assert all(len(v) == 1 for v in by_text.values())


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the cat and the dog " * 3 + str(i), "en") for i in range(30)] + [("der hund und die katze " * 3 + str(i), "de") for i in range(20)]
    rows += [(None, "en"), ("x", None), ("", "de")] + [("copy of the copy", "en")] * 50
    return langid.train(spark.createDataFrame(rows, "text string, lang string"))


def test_edge_cases(spark, model):
    df = spark.createDataFrame([(1, "the dog"), (2, "die katze"), (3, None), (4, ""), (5, "12 34 !!"), (6, "日本語"), (7, "the dog")], "i int, text string")
    got = {r["i"]: (r["language"]["lang"], r["language"]["score"]) for r in langid.identify(df, model).collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and got[1] == got[7]
    assert got[3] == got[4] == got[5] == ("und", 0.0) and got[6][0] == "en"
    kept = langid.keep_identified(df.withColumnRenamed("i", "language"), model)
    assert kept.columns == ["language", "text"] and sorted(r["language"] for r in kept.collect()) == [1, 2, 6, 7]
    nothing = langid.train(df.selectExpr("text", "cast(null as string) lang"))
    assert {r["language"]["lang"] for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.identify(df.where("false"), model).count() == 0


def test_blocks_give_every_gram_once():
    text = "Ab cd  ef—gh 12 ij " * 40
    whole = {n: [] for n in langid.LENGTHS}
    cut = {n: [] for n in langid.LENGTHS}
    for n, v in langid.grams(text):
        whole[n].append(v)
    for n, v in langid.grams(text, block=37):
        cut[n].append(v)
    for n in langid.LENGTHS:
        assert np.array_equal(np.concatenate(whole[n]), np.concatenate(cut[n]))


def test_filters_hold_what_they_learned_and_rates_fit():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, 2000).astype(np.uint64) for _ in range(70)]
    table = np.zeros((1 << 14, 2), np.uint64)
    for k, values in enumerate(sets):
        table[langid.set_rows(values, 1 << 14), k // 64] |= np.uint64(1 << k % 64)
    m = langid.Model([f"l{k:02d}" for k in range(70)], "l00", [table], (2,), (1.0,))
    other = rng.integers(0, 2**63, 20000).astype(np.uint64)
    for k in (0, 63, 69):
        assert m.hits(2, sets[k])[k] == 2000
        assert abs(m.hits(2, other)[k] / len(other) - m.rates[0][k]) < 0.01


@pytest.mark.parametrize("count", [4, 12, 40])
def test_mask_names_every_language_that_has_an_ngram(spark, count):
    rows = [(f"shared word{chr(97 + k % 26) * (2 + k // 26)}", f"l{k:02d}") for k in range(count)]
    m = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    values = dict(langid.grams("shared"))
    mask = m.masks(5, values[5])
    assert all(mask[:, 0] == (1 << count) - 1)
    assert m.tables[0].dtype == langid.word_type(count)


def plain_grams(text):
    """Character n-grams: lower case, each run of what is no letter as one space, one at both ends; no space alone."""
    t = "".join(c if c.isalpha() else " " for c in text.lower())
    t = " " + re.sub(" +", " ", t) + " "
    return {n: [g for g in (t[i : i + n] for i in range(len(t) - n + 1)) if g != " "] for n in langid.LENGTHS}


def test_predictions_equal_those_of_whole_sets(spark, sf_dir):
    """Sets of strings instead of filters: the same language for every document, and nearly the same score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    sets: dict = {}
    for text, lang in {(r["text"], r["lang"]) for r in docs if r["text"] is not None and r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5}:
        for n, g in plain_grams(text).items():
            sets.setdefault((lang, n), set()).update(g)
    languages = sorted({lang for lang, _ in sets})
    got = {r["doc_id"]: r for r in queries()["op10_language_id"](spark, sf_dir).collect()}
    for d in docs:
        if not brute.has_letter(d["text"]):
            assert got[d["doc_id"]]["lang_pred"] == "und"
            continue
        grams = plain_grams(d["text"])
        totals = [sum(w * sum(g in sets[lang, n] for g in grams[n]) / len(grams[n]) for n, w in zip(langid.LENGTHS, langid.WEIGHTS, strict=True) if grams[n]) for lang in languages]
        best = max(range(len(languages)), key=lambda k: totals[k])
        r = got[d["doc_id"]]
        assert (r["lang_pred"], round(r["score"], 2)) == (languages[best], pytest.approx(totals[best] / sum(totals), abs=0.02))


def test_ties_go_to_the_smaller_name(spark):
    m = langid.train(spark.createDataFrame([("one two", "b"), ("one two", "a"), ("three", "c")], "text string, lang string"))
    assert m.predict("one")[0] == "a"


def test_a_very_long_text_is_read_whole(model):
    assert model.predict("12 " * 700_000 + "der hund und die katze")[0] == "de"


def test_letters():
    for t in ("", None, "12", "a", "漢", "!é"):
        assert langid.has_letter(t) == brute.has_letter(t)


def test_texts_stay_where_nothing_was_learned(spark):
    df = spark.createDataFrame([(1, "the dog"), (2, None), (3, ""), (4, "12 34 !!"), (5, "日本語")], "i int, text string")
    nothing = langid.train(df.selectExpr("text", "cast(null as string) lang"))
    kept = langid.keep_identified(df, nothing)
    assert kept.columns == df.columns and sorted(r["i"] for r in kept.collect()) == [1, 5]
