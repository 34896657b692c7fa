import random
from itertools import pairwise

from lexatlas.operators import annotate as an

DICT = "alias string, concept_id string, concept_name string, alias_type string, status string, confidence double"


def brute(text, words):
    return sorted((w, i, i + len(w)) for w in words for i in range(len(text)) if text.startswith(w, i))


def rows(df):
    return sorted((r["doc_id"], r["alias"], r["start"], r["end"]) for r in df.collect())


def test_matchers_find_all_occurrences(spark):
    rng = random.Random(3)
    words = ["aa", "aba", "b", "😀a", "a.b", "x\\Ey"]
    texts = ["aaaa ababa", "x\\Ey a.b", "😀a😀a", "", None] + ["".join(rng.choice("ab😀.") for _ in range(40)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = sorted((i, *m) for i, t in enumerate(texts) if t for m in brute(t, words))
    table = spark.createDataFrame([(w,) for w in words], "alias string")
    assert rows(an.matches_automaton(docs, table)) == want
    assert rows(an.matches_automaton(docs, table, chunk=2)) == want  # several automata
    assert rows(an.matches_native(docs, words)) == want


def resolve(matches):
    kept = []
    for m in sorted(matches, key=lambda m: (m[0] - m[1], m[0])):
        if all(m[1] <= k[0] or k[1] <= m[0] for k in kept):
            kept.append(m)
    return sorted(kept)


def test_longest_first_and_links(spark):
    words = ["函数", "复合函数", "数的", "极限"]
    entries = [(w, f"C{i}", w if w != "极限" else "极限概念", "alias", "auto_mapped", 0.8125 if i else 0.0) for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, "复合函数的极限 `函数` 函数"), (2, "无"), (3, "$函数$ 极限极限")], "doc_id int, text string")
    got = an.annotate(docs, spark.createDataFrame(entries, DICT))
    spans = {r["doc_id"]: [(m["start"], m["end"]) for m in r["spans"]] for r in got.collect()}
    assert spans == {1: [(0, 4), (5, 7), (13, 15)], 2: [], 3: [(5, 7), (7, 9)]}
    assert all(a[1] <= b[0] for s in spans.values() for a, b in pairwise(s))
    out = {r["doc_id"]: r["annotated"] for r in an.rendered(got, inline_links=True).collect()}
    assert out[1].startswith("[[复合函数]]的[[极限概念|极限]] `函数` [[函数]]\n\n---\n")
    assert out[1].count("| `") == 3 and "| `函数` | **函数** | C0 | 别名 | - |" in out[1]
    assert out[2] == "无" + an.NO_MATCH
    table = {(r["doc_id"], r["alias"]): r["start"] for r in an.annotation_rows(got).collect()}
    assert table == {(1, "复合函数"): 0, (1, "极限"): 5, (1, "函数"): 13, (3, "极限"): 5}


def test_both_ways_agree(spark):
    rng = random.Random(9)
    words = ["aa", "aab", "b", "ba", "a$", "c"]
    texts = ["".join(rng.choice(["a", "b", "c", "$", "$$", "`", "\n", " "]) for _ in range(60)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate([*texts, "", None])), "doc_id int, text string")
    table = spark.createDataFrame([(w, f"C{i}", f"n{i}", "alias", "auto_mapped", 0.5) for i, w in enumerate(words)], DICT)
    got = [{r["doc_id"]: [tuple(m) for m in r["spans"]] for r in an.annotate(docs, table, chunk=c).collect()} for c in (100, 4)]
    assert got[0] == got[1] and any(got[0].values())


def test_a_match_around_a_skipped_range_stays(spark):
    docs = spark.createDataFrame([(1, "ab`c`de")], "doc_id int, text string")
    got = an.annotate(docs, spark.createDataFrame([("b`c`d", "C1", "n", "alias", "auto_mapped", 1.0)], DICT))
    assert [(m["start"], m["end"]) for m in got.first()["spans"]] == [(1, 6)]


def test_overlaps_random():
    rng = random.Random(11)
    for _ in range(300):
        matches = sorted({(a, a + rng.randint(1, 6)) for a in (rng.randint(0, 20) for _ in range(rng.randint(0, 12)))})
        assert an.resolved_spans("x" * 30, lambda _, m=matches: m) == resolve(matches)


def test_entries_of_one_alias(spark):
    """The first by concept counts, whatever the order of rows, and both ways agree."""
    entries = [("b", c, n, "alias", "auto_mapped", 0.5) for c, n in (("C3", "x"), ("C1", "z"), ("C1", "y"), ("C2", "a"))]
    docs = spark.createDataFrame([(1, "b a b")], "doc_id int, text string")
    for rows in (entries, entries[::-1]):
        for chunk in (1, 9):
            spans = an.annotate(docs, spark.createDataFrame([*rows, ("a", "C0", "q", "alias", "auto_mapped", 0.5)], DICT), chunk=chunk).first()["spans"]
            assert [(m["start"], m["concept_id"], m["concept_name"]) for m in spans] == [(0, "C1", "y"), (2, "C0", "q"), (4, "C1", "y")]


def test_a_long_text_with_many_matches(spark):
    text = "ab `c` " * 40_000
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    table = spark.createDataFrame([(w, w, w.upper(), "alias", "auto_mapped", 0.5) for w in ("a", "ab", "c")], DICT)
    row = an.rendered(an.annotate(docs, table), inline_links=True).first()
    assert len(row["spans"]) == 40_000 and row["annotated"].startswith("[[AB|ab]] `c` [[AB|ab]] ") and row["annotated"].count("\n| `") == 1


def test_both_ways_agree_on_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "aa b"), (None, "c"), (1, "aa"), (1, "b c"), (2, "b c"), (3, None), (None, None)], "doc_id int, text string")
    table = spark.createDataFrame([(w, f"C{i}", f"n{i}", "alias", "auto_mapped", 0.5) for i, w in enumerate(["aa", "b", "c"])], DICT)
    got = [sorted((str(r["doc_id"]), str(r["text"]), [(m["start"], m["end"], m["alias"]) for m in r["spans"]]) for r in an.annotate(docs, table, chunk=c).collect()) for c in (100, 2)]
    assert got[0] == got[1] and ("None", "aa b", [(0, 2, "aa"), (3, 4, "b")]) in got[1] and ("1", "aa", [(0, 2, "aa")]) in got[1]
