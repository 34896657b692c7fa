import random

import brute
import pytest
from pyspark.sql import functions as F

from lexatlas.llm import htmltext, mixing, simhash
from lexatlas.llm.components import components
from lexatlas.llm.uneven import hot_keys, hot_of, join_dealt

SCHEMA = "k string, n int, `a.b` int, __lx_key int"


def odd_rows():
    return [(k, i, i % 3, None) for k, times in ((None, 300), ("x", 200), ("y", 20), ("z", 1), ("", 2)) for i in range(times)]


def test_hot_keys(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    names = {r["h"]: r["k"] for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert {names[r["h"]]: r["salts"] for r in hot_keys(df, ["k"], 30).collect()} == {None: 10, "x": 7}
    assert hot_keys(df, ["k"], 300) is None and hot_keys(df.where("false"), ["k"], 1) is None
    counted = spark.createDataFrame([(1, 10), (2, 31), (3, 1)], "h long, n long")
    assert [(r["h"], r["salts"]) for r in hot_of(counted, 10).collect()] == [(2, 4)]
    assert hot_of(counted, 31) is None and hot_of(counted.where("false")) is None


@pytest.mark.parametrize("by", [None, ["n"]])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_of_dealt_keys_is_the_plain_join(spark, how, by):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    keyed = spark.createDataFrame([(None, 1), ("x", 2), ("z", 3), ("q", 4)], "k2 string, __LX_v int")
    hot = hot_keys(df, ["k"], 30)
    got = join_dealt(df, keyed, {"k": "k2"}, hot, how, by)
    want = df.join(keyed, F.col("k").eqNullSafe(F.col("k2")), how)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # no task gets more rows of a key than the bound, about
    plan = got._jdf.queryExecution().toString()
    assert "pmod" in plan and join_dealt(df, keyed, {"k": "k2"}, None, how, by).count() == want.count()


def test_components_with_hot_nodes(spark):
    edges = [(0, i) for i in range(1, 150)] + [(500, i) for i in range(140, 260)] + [(900, 901), (901, 902)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), hot_rows=5).collect()}
    assert got == {**{i: 0 for i in (*range(260), 500)}, 900: 900, 901: 900, 902: 900}


def test_near_duplicates_with_hot_keys(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(40)) for _ in range(20)]
    rows = [(i, base[0]) for i in range(60)] + [(7, base[0])] * 20 + [(100 + i, t) for i, t in enumerate(base)] + [(None, base[1])] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [brute.fingerprint(t) for _, t in rows]
    want = sorted(str((i, c)) for (i, _), c in zip(rows, brute.classes(prints, [i for i, _ in rows]), strict=True))
    got = simhash.near_duplicates(docs, hot_rows=4, group_most=3).collect()
    assert sorted(str((r["doc_id"], r["component_id"])) for r in got) == want
    kept = simhash.drop_near_duplicates(docs, hot_rows=4, group_most=3).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(brute.classes(prints, [i for i, _ in rows])))


def test_mix_with_many_sources_and_hot_rows(spark):
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 else f"s{i % 40}" if i % 4 else None, "w " * rng.randint(0, 30)) for i in range(400)] + [(9, "hot", "w w w")] * 90
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plain = sorted(map(str, mixing.mix_sizes(docs).collect()))
    assert sorted(map(str, mixing.mix_sizes(docs, few=0, hot_rows=10).collect())) == plain
    taken = sorted(map(str, mixing.mix_documents(docs).collect()))
    assert sorted(map(str, mixing.mix_documents(docs, few=0, hot_rows=10).collect())) == taken


def test_pages_with_hot_templates(spark):
    page = "<html><body><div class='t'><p>{}</p></div><div class='nav'>menu</div></body></html>"
    rows = [(i, "http://h/x", page.format("same text")) for i in range(60)] + [(100 + i, "http://h/y", page.format(f"text {i}")) for i in range(60)] + [(300, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    plain = sorted(map(str, htmltext.main_texts(pages).collect()))
    assert len(plain) == len(rows) and sorted(map(str, htmltext.main_texts(pages, hot_rows=5).collect())) == plain
