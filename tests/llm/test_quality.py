import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexatlas.llm import quality
from lexatlas.llm.quality import FEATURES, features, score_quality


def auc(score, label):
    pairs = [(s, y) for s, y in zip(score, label, strict=True)]
    good, bad = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_rows_are_told(spark):
    """Held-out accuracy on the given tables."""
    sf = "/root/testdata/sf0.01"
    got = quality.op11_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    label = [r["quality"] for r in got]
    assert auc([r["score"] for r in got], label) > 0.98
    assert sum(r["predicted"] == r["quality"] for r in got) >= 0.96 * len(got)
    clean = [r["predicted"] for r in got if r["quality"] == 1]
    assert sum(clean) >= 0.96 * len(clean) and all(0 <= r["score"] <= 1 for r in got)


def words(rng, good):
    return " ".join(rng.choice(["stone", "river", "Tree", "winter.", "of", "the"]) if good or rng.random() < 0.3 else rng.choice(["##x", "A$$", "%%%b", "B&&"]) for _ in range(60))


def sample(n, part, seed=0):
    rng = random.Random(seed)
    return [(i, words(rng, good := rng.random() < part), int(good)) for i in range(n)]


@pytest.mark.parametrize("part", [0.3, 0.8])
def test_prior_and_scores_without_negative_labels(spark, part):
    rows = sample(900, part)
    docs = spark.createDataFrame([(i, t, "q", 1) for i, t, _ in rows], "doc_id long, text string, label string, f int")
    labels = spark.createDataFrame([(i, 1, 1) for i, _, y in rows if y and i % 2], "doc_id long, quality int, id int")
    got = {r["id"]: r for r in score_quality(docs, labels).collect()}
    assert abs(got[0]["prior"] - part) < 0.12
    out = [(got[i]["score"] >= 0.5, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    assert sum(a == bool(y) for a, y in out) >= 0.95 * len(out)


def test_labels_that_must_stay_unread(spark):
    """Zeros and held-out labels change nothing."""
    rows = sample(300, 0.6, 3)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    yes = [(i, 1) for i, _, y in rows if y and i % 2]
    more = [(i, 0) for i, _, y in rows if not y] + [(i, 1 - y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1 and i % 2 == 0]
    a, b = (sorted((r["id"], round(r["score"], 9)) for r in score_quality(docs, spark.createDataFrame(x, "doc_id long, quality int").coalesce(1)).collect()) for x in (yes, yes + more))
    assert a == b


def test_odd_rows(spark):
    rows = sample(200, 0.7, 5)
    odd = [(None, None), (None, "x"), (1000, None), (1001, ""), (1002, "😀 " * 3), (1003, "a" * 300_000), (7, rows[7][1]), (7, "other")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + odd, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] * 2 + [(None, 1), (8, 0), (8, 1), (9, None)], "doc_id long, quality int")
    got = score_quality(docs, labels, hot_rows=1).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] for r in got if r["id"] is None)
    assert len({r["score"] for r in got if r["id"] in (1000, 1001)}) == 1
    none = score_quality(docs, labels.where("quality = 0")).collect()
    assert {r["score"] for r in none} == {0.5} and len(none) == len(got)
    assert score_quality(docs.where("false"), labels).collect() == [] and len(score_quality(docs, labels.where("false")).collect()) == len(got)


def test_trusted(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(ids[0], 1), (ids[0], 1), (ids[1], 1), (ids[1], 0), (ids[2], 0), (ids[3], None), (ids[3], 1), (next(i for i in range(60) if i not in ids), 1), (None, 1)]
    got = quality.trusted(spark.createDataFrame(rows, "doc_id long, quality int"))
    assert sorted(r["id"] for r in got.collect()) == sorted([ids[0], ids[3]])


def test_features_by_blocks(monkeypatch):
    text = "Abc def.\nAbc  12 &é日\n" * 50
    whole = features(text)
    assert len(whole) == FEATURES and np.isfinite(whole).all()
    monkeypatch.setattr(quality, "BLOCK", 11)
    parts = features(text)
    assert np.allclose(parts[: quality.CLASSES + quality.PAIRS], whole[: quality.CLASSES + quality.PAIRS])
    assert features("")[-1] == 1.0 and features(None).tolist() == features("").tolist()


def test_moments_and_risk(spark):
    """Against plain sums, and differences of the risk."""
    rng = np.random.default_rng(1)
    x = rng.random((50, FEATURES)).astype("<f2")
    yes = rng.random(50) < 0.4
    rows = spark.createDataFrame([(bool(y), bytearray(v.tobytes())) for y, v in zip(yes, x, strict=True)], "positive boolean, f binary").repartition(3)
    scale = quality.scale_of(rows)
    z = scale(x.astype(float))
    assert np.allclose(z[:, :-1].mean(0), 0, atol=1e-9)
    w = rng.normal(0, 0.1, FEATURES + 1)
    loss = lambda g: np.log1p(np.exp(-g))

    def plain(w):
        g = z @ w
        return 0.6 * loss(g[yes]).mean() - 0.2 * g[yes].mean() + 0.3 * loss(-g).mean() + 0.005 * w @ w

    value, slope, curve = quality.risk(quality.moments(rows, scale, w), w, 0.6, 0.2, 0.3, 0.01)
    d = rng.normal(0, 1, len(w))
    assert math.isclose(value, plain(w))
    assert math.isclose(slope @ d, (plain(w + 1e-5 * d) - plain(w - 1e-5 * d)) / 2e-5, rel_tol=1e-4)
    assert math.isclose(d @ curve @ d, (plain(w + 1e-3 * d) - 2 * plain(w) + plain(w - 1e-3 * d)) / 1e-6, rel_tol=1e-2)


def test_the_part_for_negatives_is_not_negative(spark):
    """Where the unbiased risk would overfit, its part for negatives ends near zero."""
    rows = sample(240, 0.8, 9)
    data = [(bool(y and i % 3), i % 3, bytearray(features(t).astype("<f2").tobytes())) for i, t, y in rows]
    df = spark.createDataFrame(data, "positive boolean, part int, f binary").withColumn("part", F.col("part").cast("long"))
    model = quality.train(df)
    m = quality.moments(df.select("positive", "f"), model.scale, model.w)
    assert m.u["minus"] - model.prior * m.p["minus"] > -0.05
