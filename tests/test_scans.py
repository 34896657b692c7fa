"""Prefix scans over ranges: places, trees and spans whose key lies in many partitions."""

import random

from pyspark.sql import functions as F
from test_annotate import resolve
from test_knowledge import tree_spec

from lexatlas.functions import scans
from lexatlas.operators import hierarchy, spans

ENTRY = "book_id int, ordinal long, level int, number string, title string, parent_number string"


def test_places_of_a_hot_key_over_ranges(spark):
    rng = random.Random(4)
    keys = [rng.choice(["hot", "hot", "hot", "a", "b", None]) for _ in range(600)]
    df = spark.createDataFrame([(k, i * 3, f"x{i}") for i, k in enumerate(keys)], "k string, o int, n string").repartition(5)
    laid = scans.places(df, "at", ["k"], ["o"], 16)
    seen, want = {}, {}
    for i, k in enumerate(keys):
        seen[k] = seen.get(k, 0) + 1
        want[f"x{i}"] = (k, seen[k])
    assert {r["n"]: (r["k"], r["at"]) for r in laid.collect()} == want
    parts = scans.ranged_scan(df, ["k"], ["o"], scans.PLACES, 16)
    assert parts.where("k = 'hot'").select(f"{scans.CARRY}.n").distinct().count() > 5  # it does lie in many
    assert scans.places(df.limit(0), "at", ["k"], ["o"], 16).collect() == []
    assert sorted(r["at"] for r in scans.places(df, "at", [], ["o"], 8).collect()) == list(range(1, 601))  # no key: all rows


def test_places_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scans, "CARRIED", -1)
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    got = scans.places(df, "at", ["k"], ["o"], 7)
    assert "rightHint" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["k"], r["o"], r["at"]) for r in got.collect()} == {(i % 2, i, i // 2 + 1) for i in range(100)}


def test_stacks_are_associative():
    rng = random.Random(5)
    scan = hierarchy.STACKS

    def summary(entries):
        state = scan.start()
        for e in entries:
            scan.step(state, *e)
        return scan.close(state)

    for _ in range(300):
        runs = [[(rng.choice([None, -1, 0, 1, 2, 3, 4]), rng.choice("ab"), None) for _ in range(rng.randint(1, 6))] for _ in range(3)]
        a, b, c = map(summary, runs)
        assert scan.after(scan.after(a, b), c) == scan.after(a, scan.after(b, c)) == summary(sum(runs, []))


def test_one_book_in_sixteen_partitions(spark):
    rng = random.Random(6)
    entries = [(rng.randint(1, 30) if i % 40 else 1, rng.choice("abcde"), rng.choice(["a", "b", "c", "z", "root", None])) for i in range(800)]
    zeros = [(rng.randint(0, 3), n, p) for _, n, p in entries[:200]]
    rows = [(book, i, lv, n, f"t{i}", p) for book, es in ((1, entries), (2, zeros)) for i, (lv, n, p) in enumerate(es)]
    got: dict = {}
    for r in hierarchy.chapter_tree(spark.createDataFrame(rows, ENTRY).repartition(3), "root", partitions=16).orderBy("book_id", "id").collect():
        got.setdefault(r["book_id"], []).append((r["id"], r["parent_id"]))
    assert got == {b: [(1, None), *tree_spec(es)] for b, es in ((1, entries), (2, zeros))}


def test_levels_that_are_null_or_below_zero(spark):
    rows = [(1, 1, 1, "a", "t", None), (1, 2, None, "b", "t", "a"), (1, 3, 2, "c", "t", "a"), (1, 4, -1, "d", "t", None), (1, 5, 2, "e", "t", "a"), (None, 1, 1, None, None, None)]
    for n in (1, 6):
        got = {(r["book_id"], r["id"]): r["parent_id"] for r in hierarchy.chapter_tree(spark.createDataFrame(rows, ENTRY), "root", partitions=n).collect()}
        assert got == {(1, 1): None, (1, 2): 1, (1, 3): 1, (1, 4): 2, (1, 5): 1, (1, 6): 1, (None, 1): None, (None, 2): 1}


SPAN = "doc_id int, start int, end int"


def test_spans_over_sixteen_ranges(spark):
    rng = random.Random(7)
    rows, regions = [], []
    for doc in range(4):
        for _ in range((400, 60, 5, 0)[doc]):
            a = rng.randrange(900 if doc else 2000)
            rows.append((doc, a, a + rng.choice([1, 2, 3, 5, 9, 30])))
        for _ in range(25):
            a = rng.randrange(2000)
            regions.append((doc, a, a + rng.choice([0, 1, 4, 12, 60])))
    rows += [(1, 5, 5), (1, None, 4), (None, 1, 2)] + rows[:20]
    inside = lambda doc, at: any(d == doc and a <= at < b for d, a, b in regions)
    want = []
    for doc in range(4):
        free = {(a, b) for d, a, b in rows if d == doc and a is not None and a < b and not inside(doc, a) and not inside(doc, b - 1)}
        want += [(doc, a, b) for a, b in resolve(free)]
    got = spans.resolve(spark.createDataFrame(rows, SPAN).repartition(3), spark.createDataFrame(regions, SPAN), partitions=16)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100
    none = spark.createDataFrame([], SPAN)
    assert sorted(map(tuple, spans.resolve(spark.createDataFrame([(1, 2, 4), (1, 3, 9)], SPAN), none).collect())) == [(1, 3, 9)]
    assert spans.resolve(none, none).collect() == []


def test_a_region_over_many_ranges(spark):
    rows = [(1, i, i + 1) for i in range(300)]
    regions = spark.createDataFrame([(1, 40, 260)], SPAN)
    got = spans.resolve(spark.createDataFrame(rows, SPAN), regions, partitions=16)
    assert sorted(r["start"] for r in got.collect()) == [*range(40), *range(260, 300)]
    long = spark.createDataFrame([(1, 0, 1000), *[(1, i, i + 2) for i in range(0, 900, 3)]], SPAN)
    island = spans.islands(long, partitions=16)
    assert island.select("island").distinct().count() == 1 and island.count() == 301
    assert [tuple(r) for r in spans.resolve(long, regions.limit(0), partitions=16).collect()] == [(1, 0, 1000)]
