import random

import pytest

from lexatlas.operators import anchors
from lexatlas.operators import annotate as an

DICT = "alias string, concept_id string, concept_name string, alias_type string, status string, confidence double"
WORDS = ["".join(random.Random(i).choices("abcde", k=6)) for i in range(40)]


def texts(spark, n):
    rng = random.Random(n)
    return spark.createDataFrame([(i, " ".join(rng.choices(WORDS, k=30))) for i in range(n)], "doc_id int, text string").repartition(4)


def entries(spark, words):
    return spark.createDataFrame([(w, f"C{i}", f"n{i}", "alias", "auto_mapped", 0.5) for i, w in enumerate(words)], DICT)


def test_a_part_asks_once_for_what_its_texts_hold(spark):
    """What is shuffled grows with the different words of a part, not with texts x words (F1 to F4)."""
    some = entries(spark, [*WORDS, *(f"none{i}of{i}these" for i in range(500))])
    own = [anchors.dictionaries(laid, some, text_col="text").count() / n for laid, n in (anchors.parts(texts(spark, k), "text") for k in (100, 400))]
    assert own[0] == own[1] == len(set(WORDS))


def test_parts_are_whole_and_bounded(spark, monkeypatch):
    for name, value in (("PART", 5000), ("LEAST", 5000), ("PIECE", 500)):
        monkeypatch.setattr(anchors, name, value)
    docs = texts(spark, 400)
    laid, n = anchors.parts(docs, "text")
    sizes = [r[0] for r in laid.groupBy("__part").agg({"text": "count"}).select("count(text)").collect()]
    assert sum(sizes) == 400 and len(sizes) == n > 10 and max(sizes) * 209 < 6500
    some = entries(spark, WORDS)
    spans = lambda d: sorted((r["doc_id"], [tuple(m) for m in r["spans"]]) for r in d.collect())
    assert spans(an.annotate(docs, some, chunk=1)) == spans(an.annotate(docs, some))


@pytest.mark.parametrize("ids", ["id", "id % 3", "nullif(id % 5, 4)"])
def test_counts_of_matches(spark, ids):
    """Counted where texts are (F2), and right where ids repeat or are null."""
    docs = texts(spark, 60).selectExpr("doc_id id", "text").selectExpr(f"{ids} doc_id", "text").union(spark.sql("select null, null"))
    words = spark.createDataFrame([(w,) for w in [*WORDS, "a", "a" * 20, "no such word"]], "alias string")
    want: dict = {}
    for r in docs.collect():
        for (w,) in words.collect():
            for at in range(len(r["text"] or "")):
                if r["text"].startswith(w, at):
                    n, start, of = want.get(w, (0, 0, frozenset()))
                    want[w] = n + 1, start + at, of | {r["doc_id"]} - {None}
    for chunk in (1, 1000):
        got = {r["alias"]: (r["n"], r["sum_start"], r["n_docs"]) for r in an.match_counts(docs, words, chunk=chunk).collect()}
        assert got == {w: (n, s, len(of)) for w, (n, s, of) in want.items()}


def test_rows_of_texts_whose_ids_occur_once(spark):
    """The table of words is made where texts are (F4): no row of it is shuffled."""
    docs = texts(spark, 50)
    done = an.annotate(docs, entries(spark, WORDS), chunk=1000)
    assert an.ids_once(docs, "doc_id") and not an.ids_once(docs.union(docs.limit(1)), "doc_id")
    once, grouped = (an.annotation_rows(done, once=o) for o in (True, False))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, grouped.collect()))
    assert "Exchange hashpartitioning(doc_id" not in once._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(5))
def test_islands(seed):
    """Overlaps (F3) by islands as by going through all matches."""
    rng = random.Random(seed)
    text = "".join(rng.choice("ab`$\n ") for _ in range(400))
    spans = sorted({(a, a + rng.randint(1, 9)) for a in rng.choices(range(390), k=rng.choice([0, 3, 60, 300]))})
    inside = [m.span() for p in an._SKIP for m in p.finditer(text)]
    kept: list = []
    for a, b in sorted(spans, key=lambda m: (m[0] - m[1], m[0])):
        if not any(x <= a < y or x < b <= y for x, y in inside) and all(b <= x or y <= a for x, y in kept):
            kept.append((a, b))
    assert an.resolved_spans(text, lambda _: spans) == sorted(kept)


@pytest.mark.parametrize("fields", [("start", "end"), ("end", "concept_name"), an.NAMES])
def test_texts_are_not_shuffled(spark, monkeypatch, fields):
    """Texts meet their part's entries where they are read, and entries have only what spans need (F3)."""
    for name, value in (("PART", 2000), ("LEAST", 2000), ("PIECE", 500)):
        monkeypatch.setattr(anchors, name, value)
    shipped, inner = [], anchors.dictionaries
    monkeypatch.setattr(anchors, "dictionaries", lambda *a, **b: shipped.append(inner(*a, **b)) or shipped[0])
    docs = texts(spark, 60).union(spark.sql("select null, null union all select 3, '' union all select 99, 'zzz'"))
    some = entries(spark, [*WORDS, "ab", "b", "no such word"])
    done = an.annotate(docs, some.union(some.limit(5)), chunk=1, fields=fields)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    assert shipped[0].columns == ["__part", "alias", *(f for f in fields if f in an.NAMES[3:])]
    rows = lambda d: sorted((str(r["doc_id"]), str(r["text"]), [tuple(m[f] for f in fields) for m in r["spans"]]) for r in d.collect())
    assert rows(done) == rows(an.annotate(docs, some)) == rows(an.annotate(docs, some, fields=fields))
