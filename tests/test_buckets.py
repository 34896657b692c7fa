"""Tables in buckets, increments kept in them, and replies that are asked for once."""

import random
from pathlib import Path

import pytest
from test_knowledge import segs

from lexatlas import providers, schemas
from lexatlas.operators import concepts
from lexatlas.sources import buckets
from lexatlas.streaming import incremental

ROW = "k string, v long"


def table(spark, path):
    return {r["k"]: r["v"] for r in buckets.read_buckets(spark, path, spark.createDataFrame([], ROW).schema).collect()}


def files(path):
    return {p for p in Path(path).rglob("*.parquet") if "data" in p.parts}


def test_upserts_leave_other_buckets_alone(spark, tmp_path):
    path, want, rng = f"file://{tmp_path}/t", {}, random.Random(8)
    assert table(spark, path) == {}
    first = {f"k{i}": i for i in range(200)} | {None: -1, "": 0}
    assert len(buckets.upsert_buckets(spark.createDataFrame(list(first.items()), ROW), path, "k", buckets=16)) == 16
    want |= first
    before = files(tmp_path)
    change = {"k3": 33, "new": 1, None: -2}
    touched = buckets.upsert_buckets(spark.createDataFrame(list(change.items()), ROW), path, "k", buckets=999)  # the table keeps its 16
    want |= change
    assert table(spark, path) == want and 1 <= len(touched) <= 3
    assert before <= files(tmp_path)  # nothing is rewritten in place; the version before can still be read
    made = files(tmp_path) - before
    assert {p.parent.name for p in made} == {f"__bucket={b}" for b in touched}
    for _ in range(3):
        change = {f"k{rng.randrange(260)}": rng.randrange(99) for _ in range(4)}
        buckets.upsert_buckets(spark.createDataFrame(list(change.items()), ROW), path, "k")
        want |= change
        assert table(spark, path) == want
    gone = before - files(tmp_path)
    assert gone and {p.parent.name for p in gone} >= {f"__bucket={b}" for b in touched}  # replaced twice: deleted
    assert buckets.upsert_buckets(spark.createDataFrame([], ROW), path, "k") == [] and table(spark, path) == want


def test_one_of_two_writers_gets_an_error(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    buckets.upsert_buckets(spark.createDataFrame([("a", 1)], ROW), path, "k", buckets=4)
    seen = buckets.version(spark, path)
    buckets.upsert_buckets(spark.createDataFrame([("b", 2)], ROW), path, "k", base=seen)
    left = files(tmp_path)
    with pytest.raises(OSError):
        buckets.upsert_buckets(spark.createDataFrame([("a", 9), ("c", 3)], ROW), path, "k", base=seen)
    assert table(spark, path) == {"a": 1, "b": 2} and files(tmp_path) == left


def base(spark, folder):
    both = [buckets.read_buckets(spark, f"{folder}/{n}", s) for n, s in (("concepts", schemas.CONCEPTS), ("aliases", schemas.ALIASES))]
    return [sorted(map(repr, t.collect())) for t in both]


def test_increments_in_buckets_equal_whole_ones(spark, tmp_path):
    parts = [segs(spark, ("a", "concept", ["x"], "e, f"), ("q", "note", [], "a")), segs(spark, ("b", "concept", ["x", "y"], "z"), ("a", "concept", ["w"], "")), segs(spark, ("w", "theorem", ["b"], "q"))]
    folder, c, a = f"file://{tmp_path}/kb", None, None
    for p in parts:
        c, a = (spark.createDataFrame(t.collect(), t.schema) for t in concepts.build_base(p, c, a))
        written = incremental.increment_buckets(spark, p, folder, buckets=32)
        assert base(spark, folder) == [sorted(map(repr, t.collect())) for t in (c, a)]
    assert len(written["concepts"]) == 1 and len(written["aliases"]) <= 2  # w is a concept; q and w's own name is there
    kept = files(tmp_path)
    assert incremental.increment_buckets(spark, parts[-1], folder) == {"aliases": [], "concepts": []}  # again: no file changes
    assert files(tmp_path) <= kept


def test_questions_are_asked_once(spark, tmp_path):
    log = tmp_path / "asked"

    def ask(alias, name, content):
        with log.open("a") as f:
            f.write(f"{alias}\n")
        if alias == "bad" or (alias == "late" and log.read_text().count("late") < 2):
            raise ValueError("no answer")
        return '{"decision": "高关联", "reason": "' + f"{alias} {name}" + '"}'

    judge = providers.kept_judge(providers.reply_judge(ask), f"file://{tmp_path}/replies", attempts=3, buckets=4)
    rows = [(1, "a", "n", "c"), (2, "a", "n", "c"), (3, "a", "m", "c"), (4, "late", "n", "c"), (5, "bad", "n", "c"), (6, "an", "", "c"), (7, "a", "n", None)]
    asked = spark.createDataFrame(rows, "id int, alias string, name string, content string")
    for _ in range(2):  # two actions over one plan
        said = judge(asked) if _ == 0 else said
        got = {r["id"]: (r["decision"], r["reason"]) for r in said.collect()}
        assert got == {i: ("高关联", f"{a} {n}") for i, a, n, _c in rows if a != "bad"} | {5: ("无关联", "failed: no answer")}
    calls = log.read_text().split()
    assert {a: calls.count(a) for a in set(calls)} == {"a": 3, "late": 2, "bad": 3, "an": 1}
    again = judge(asked)
    assert again.count() == 7
    calls = log.read_text().split()
    assert {a: calls.count(a) for a in set(calls)} == {"a": 3, "late": 2, "bad": 6, "an": 1}  # only what failed
    assert judge(asked.limit(0)).collect() == []
