import functools
import random

import numpy as np
import pandas as pd
import pytest

from lexatlas.functions import vectors
from lexatlas.operators import align
from lexatlas.plans import adapters as ad
from lexatlas.plans import catalogue


@pytest.mark.parametrize("kind", ["float", "double"])
def test_the_best_of_all_groups(spark, monkeypatch, kind):
    """One row an alias and group, ties to the first concept whichever block or group it is in (F5, F6)."""
    monkeypatch.setattr(align, "blocks", functools.partial(vectors.blocks, size=7))
    monkeypatch.setattr(align, "BLOCK", 5)
    rng, sent = random.Random(1), []
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(90)]
    df = spark.createDataFrame([*rows, (90, None)], f"id int, embedding array<{kind}>")
    inner = vectors.meet
    monkeypatch.setattr(align, "meet", lambda *a: sent.append(inner(*a, group=7 * 2048 * 12)) or sent[0])
    got = {r["alias"]: (r["best"], round(r["similarity"], 9)) for r in align.best_match(df.withColumnRenamed("id", "alias"), df.withColumnRenamed("id", "concept_id")).collect()}
    want = {}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if any(v)}
    for i, v in unit.items():
        s = {j: float(v @ w) for j, w in unit.items()}
        top = max(s.values())
        want[i] = min(j for j, x in s.items() if x >= top - 1e-12), round(top, 9)
    assert got == want
    blocks_, size = -(-90 // 7), vectors.grouped(3, -(-90 // 7), -(-90 // 7), 4, 7 * 2048 * 12)
    assert size > 1 and sent[0].count() <= 90 * -(-blocks_ // size)


def test_vectors_are_shipped_a_few_times():
    """300 blocks of 64 dimensions a side: 5 groups, not 75."""
    assert -(-300 // vectors.grouped(64, 300, 300, 6)) == 5
    assert vectors.grouped(64, 5, 5, 6) == 2 and vectors.grouped(64, 1, 1, 6) == 1 and vectors.grouped(100_000, 300, 300, 6) == 1


@pytest.mark.parametrize("query", ["align_rerun", "dictionary_load"])
def test_matches_are_laid_down(spark, sf_dir, query):
    """The plan of a second alignment, or of a join, has no products of vectors of its own."""
    plan = catalogue.QUERIES[query](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan


def test_single_vectors_are_shipped_as_such(spark, sf_dir):
    packed, _ = vectors.blocks(ad.read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    assert packed.schema["data"].dataType.simpleString() == "array<float>"


def test_joins_of_matches_carry_no_vectors(spark, sf_dir):
    """Whether an alias has a vector is told before the joins (F6)."""
    plan = catalogue.QUERIES["dictionary_load"](spark, sf_dir)._jdf.queryExecution().optimizedPlan()
    joins = [plan]
    for node in joins:
        joins += [node.children().apply(i) for i in range(node.children().size())]
    carried = ["embedding" in n.output().toString() for n in joins if n.nodeName() == "Join"]
    assert carried and not any(carried)


def test_vectors_are_laid_down_once(spark, tmp_path, monkeypatch):
    """Groups are read where they lie: no vector is shuffled for each group of the other side (F6)."""
    monkeypatch.setattr(vectors, "scratch_path", lambda s, tag: f"file://{tmp_path}/{tag}-{len(list(tmp_path.iterdir()))}")
    rng = random.Random(2)
    df = spark.createDataFrame([(i, [rng.random() for _ in range(3 + i % 2)]) for i in range(300)] + [(300, []), (301, None)], "id int, v array<float>")
    sides = [vectors.blocks(df, "v", size=5), vectors.blocks(df.where("id % 3 = 0 or id % 2 = 0"), "v", size=5)]
    run = lambda a, c: pd.DataFrame([(x, y) for i in a["id"] for x in i for j in c["id"] for y in j], columns=["x", "y"])
    met = vectors.meet(*sides, run, "x int, y int", group=2 * 2048 * 3 * 4)
    assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString() and met.rdd.getNumPartitions() > 40
    want = sorted((x, y) for x in range(300) for y in range(300) if x % 2 == y % 2 and (y % 3 == 0 or y % 2 == 0))
    assert sorted(map(tuple, met.collect())) == want
    stored = [spark.read.parquet(str(p)).selectExpr("explode(id) i").count() for p in sorted(tmp_path.iterdir())]
    assert stored == [300, 200]
    assert vectors.meet(sides[0], vectors.blocks(df.where("false"), "v"), run, "x int, y int").count() == 0
