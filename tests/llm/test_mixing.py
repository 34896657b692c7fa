import brute
import pytest
from pyspark.sql import functions as F

from lexatlas.llm import mixing
from lexatlas.llm.queries import queries

DOCS = "doc_id long, text string, source string"


def by_source(rows):
    out = {}
    for r in rows:
        s = out.setdefault(r["source"], {"size": 0, "taken": 0, "target": r["target"], "source_size": r["source_size"]})
        s["size"] += r["size"]
        s["taken"] += r["taken"]
    return out


def check(spark, docs, slack=1.0):
    rows = mixing.mix_sizes(docs).collect()
    texts = docs.collect()
    assert len(rows) == len(texts)
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(t["doc_id"]), brute.size(t["text"])) for t in texts)
    got = by_source(rows)
    want = brute.targets({s: x["size"] for s, x in got.items()}) if got else {}
    largest = {}
    for r in rows:
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 3 * r["size"]
    for s, x in got.items():
        assert x["source_size"] == x["size"] and x["target"] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert abs(x["taken"] - x["target"]) <= slack * largest[s] + 1e-6
    again = mixing.mix_sizes(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    return rows


def test_whole_table(spark):
    """Fifty documents a source: small ones make up for what large ones leave over."""
    rows = queries()["op1_mix_sources"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    for x in by_source(rows).values():
        assert abs(x["taken"] - x["target"]) <= max(0.02 * x["target"], 400)


def test_edge_cases(spark):
    rows = [(i, "w " * (i % 17 + 1), "abc"[i % 3]) for i in range(400)]
    rows += [(None, "x y", None), (1, None, "a"), (2, "", "b"), (3, " \n", "only empty"), (4, "v " * 5000, "a")] + [(7, "same text here", "hot")] * 300
    check(spark, spark.createDataFrame(rows, DOCS))


def test_empty_table(spark):
    assert mixing.mix_sizes(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mix_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_many_blocks_keep_the_mass(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 40 + 1).cast("int")).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    got = by_source(mixing.mix_sizes(docs).collect())
    assert all(abs(x["taken"] - x["target"]) <= 41 for x in got.values())


def test_documents_are_repeated_as_taken(spark):
    rows = [(i, f"w{i} " * (i % 9 + 1), "abc"[i % 3], "q") for i in range(300)] + [(5, "dup", "c", str(k % 2)) for k in range(40)]
    docs = spark.createDataFrame(rows, DOCS + ", `copies.x` string")
    got = mixing.mix_documents(docs)
    assert got.columns == docs.columns
    counts = {(r["doc_id"], r["text"]): r["n"] for r in got.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {}
    texts = {(r[0], brute.size(r[1])): r[1] for r in rows}
    for r in mixing.mix_sizes(docs).collect():
        key = (r["doc_id"], texts[r["doc_id"], r["size"]])
        want[key] = want.get(key, 0) + r["copies"]
    assert counts == {k: v for k, v in want.items() if v}


def test_expectations_are_kept(spark):
    """Over seeds, an item is taken as often as its ratio says."""
    docs = spark.createDataFrame([(i, "w " * (3 + i), "a" if i < 12 else "b") for i in range(24)], DOCS)
    runs = 12
    seen: dict = {}
    ratio = {}
    for seed in range(runs):
        for r in mixing.mix_items(docs, seed=seed).select("doc_id", "copies", "ratio").collect():
            seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["copies"]
            ratio[r["doc_id"]] = r["ratio"]
    mean = {i: n / runs for i, n in seen.items()}
    assert all(abs(mean[i] - ratio[i]) < 0.6 for i in mean)
    assert abs(sum(mean.values()) - sum(ratio.values())) < 0.05 * sum(ratio.values())
