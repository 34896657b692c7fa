import math
import random

import numpy as np
import pytest
from oracle import compare

from lexatlas.llm import topk, warc
from lexatlas.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    compare(spark, sf_dir, queries()[name], oracle_sql()[name])


def brute_topk(rows, k, scale=64):
    v = [(i, [math.floor(scale * z) for z in x]) for i, x in rows if x is not None and all(z is not None and math.isfinite(z) for z in x)]
    out = []
    for i, a in v:
        if i is not None and i % 20 == 0:
            best = sorted((-sum(p * q for p, q in zip(a, b, strict=False)), j is None, j or 0) for j, b in v if j != i)[:k]
            out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(best, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "spread"), [(64, 3.0), (4096, 1.0), (16, 0.1)])
def test_topk_random(spark, monkeypatch, block, spread):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 1) * (spread if i % 7 == 0 else 0.2) for _ in range(6)]) for i in range(300)]
    rows += [(401, None), (402, [1.0, None]), (403, [float("nan")]), (404, []), (None, [9.0] * 6), (20, [1.0] * 6), (440, [float("inf")] * 6), (460, [0.0] * 6)] + [(500 + i, [1.5] * 6) for i in range(60)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, block string")
    got = topk.top_products(df.where("vec_id % 20 = 0"), df, 20).collect()
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=str) == brute_topk(rows, 20)


def test_topk_of_very_large_components(spark):
    rows = [(20, [1e18, 1.0]), (1, [1e18, 2.0]), (2, [1.0, 3.0]), (3, [-1e18, 0.0]), (40, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    most = 2**63 - 1
    got = sorted(tuple(r) for r in topk.top_products(df.where("vec_id in (20, 40)"), df, 2).collect())
    # floor(64 * 1e18) is the largest long; so is each product of it but the small row's, which is beyond the range too
    assert got == [(20, 1, 1, most), (20, 2, 2, most), (40, 1, 2, 64 * 192), (40, 2, 1, 64 * 128)]


def test_topk_of_little(spark):
    df = spark.createDataFrame([(20, [1.0, 2.0]), (1, [1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_products(df.where("vec_id = 20"), df, 20).collect()] == [(20, 1, 1, 4096)]
    assert topk.top_products(df.where("false"), df, 5).count() == 0
    assert topk.top_products(df, df.where("false"), 5).count() == 0


def test_blocks_and_products_are_pruned(spark, monkeypatch):
    """Norms from 1 to 1,000: most of the rows meet no query; a long vector alone in its bucket changes nothing."""
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "HEAD_ROWS", 500)
    rng = random.Random(4)
    size = [1000 ** rng.random() for _ in range(3000)]
    rows = [(i, [rng.gauss(0, 1) * n for _ in range(8)]) for i, n in enumerate(size)] + [(3001, [9e4] + [0.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = spark.sparkContext.accumulator(0)
    got = topk.top_products(df.where("vec_id % 20 = 0"), df, 20, counter=made).collect()
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=str) == brute_topk(rows, 20)
    assert made.value < 150 * len(rows) / 4, made.value


def test_both_ways_to_prune():
    rng = np.random.default_rng(3)
    c = rng.integers(-40, 40, (500, 32))
    c[::2] *= 2
    c = c[np.argsort(-np.sqrt((c**2).sum(1)))]
    whole = c @ c[:40].T

    def products(low):
        s = topk.Search(c[:40], np.full(40, -1), low, 5)
        s.meet(c, np.arange(500))
        return s.products, s

    made, s = products(np.full(40, topk.LOWEST))
    assert made == 40 * 500
    want = np.sort(whole, 0)[-5:][::-1].T
    assert (s.best[2].reshape(40, 5) == want).all()
    norms = np.sqrt((c**2.0).sum(1))
    by_length = np.floor(norms[:40] * norms[0] * 0.55).astype(np.int64)  # longer than half of the rows reach
    made, s = products(by_length)
    assert 0 < made < 40 * 500 * 0.8 and set(zip(s.best[0], s.best[1], strict=True)) == {(q, r) for q in range(40) for r in np.lexsort((np.arange(500), -whole[:, q]))[:5] if whole[r, q] >= by_length[q]}
    by_coordinates = np.floor(norms[:40] * norms[0] * 0.8).astype(np.int64)
    made, s = products(by_coordinates)
    assert made < 40 * 500 * 0.1 and set(zip(s.best[0], s.best[1], strict=True)) == {(q, r) for q in range(40) for r in np.flatnonzero(whole[:, q] >= by_coordinates[q])}


REC = "record_id string, type string, url string, date string, headers map<string,string>, digest string, size long, sha256 string"


def resolved(spark, rows):
    return {r["record_id"]: r for r in warc.resolve_revisits(spark.createDataFrame(rows, REC)).collect()}


def test_revisits(spark):
    h = lambda **k: {a.replace("_", "-"): b for a, b in k.items()}
    got = resolved(spark, [
        ("a", "response", "http://www.X.org:80/p/?b=2&utm_source=q&a=1#f", "2020-01", h(etag='"1"', content_length="5", vary="old"), "d1", 5, "s1"),
        ("b", "response", "https://x.org/p?a=1&b=2", "2020-03", h(etag='"2"', last_modified="m2"), "d2", 7, "s2"),
        ("r1", "revisit", "http://x.org/p?a=1&b=2", "2020-02", h(etag='W/"1"', vary="new", content_length="0", server="no"), None, None, None),
        ("r2", "revisit", "http://x.org/p?a=1&b=2", "2020-04", h(etag='"1"'), None, None, None),
        ("r3", "revisit", "http://x.org/p?a=1&b=2", "2020-05", h(last_modified="m2"), None, None, None),
        ("r4", "revisit", "http://x.org/p?a=1&b=2", "2020-06", None, None, None, None),
        ("r5", "revisit", "http://x.org/p?a=1&b=2", "2020-07", h(etag='"9"'), "d2", None, None),
        ("r6", "revisit", "http://x.org/p?a=1&b=2", "2019-01", h(etag='"1"'), None, None, None),
        ("r7", "revisit", None, "2021-01", h(etag='"1"'), None, None, None),
        ("r8", "revisit", "mailto:x", "2021-01", h(etag='"1"'), None, None, None),
        ("i", "warcinfo", None, "2018-01", None, None, 3, "s"),
        ("n", "response", None, "2018-01", None, None, 3, "s"),
    ])
    assert {k: (r["status"], r["source_id"]) for k, r in got.items()} == {
        "a": ("full", None), "b": ("full", None), "r1": ("resolved", "a"), "r2": ("changed", None), "r3": ("resolved", "b"), "r4": ("unchecked", "b"), "r5": ("resolved", "b"), "r6": ("missing", None),
        "r7": ("missing", None), "r8": ("missing", None), "i": ("other", None), "n": ("full", None),
    }
    assert got["r1"]["headers"] == {"etag": 'W/"1"', "content-length": "5", "vary": "new"} and (got["r1"]["size"], got["r1"]["sha256"]) == (5, "s1")
    assert got["r2"]["headers"] == {"etag": '"1"'} and got["r2"]["sha256"] is None
    assert resolved(spark, []) == {}


def test_one_url_over_many_partitions(spark):
    rng = random.Random(6)
    rows, want, last = [], {}, {}
    for k in range(3000):
        url = "http://hot.org/" if k % 3 else f"http://u{rng.randrange(40)}.org/"
        kind = "response" if rng.random() < 0.05 else "revisit"
        rows.append((f"{k:05d}", kind, url, f"{k:05d}", {"etag": str(k)} if kind == "response" else {}, None, k, str(k)))
        if kind == "response":
            last[url] = f"{k:05d}"
        else:
            want[f"{k:05d}"] = last.get(url)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, REC).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = {r["record_id"]: r["source_id"] for r in warc.resolve_revisits(df).where("type = 'revisit'").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == want


def test_warc_bytes(spark):
    import gzip

    one = warc.write_record("response", "urn:1", "http://x/", "2020-01-01T00:00:00Z", {"Content-Encoding": "gzip", "X": "a"}, gzip.compress(b"body"))
    two = warc.write_record("revisit", "urn:2", "http://x/", "2020-01-02T00:00:00Z", {"ETag": "e"}, None, "304 Not Modified")
    got = list(warc.parse(one + two))
    assert [(r[0], r[1], r[6]) for r in got] == [("urn:1", "response", b"body"), ("urn:2", "revisit", None)]
    assert list(warc.parse(gzip.compress(one) + gzip.compress(two))) == got
    assert list(warc.parse(None)) == list(warc.parse(b"")) == list(warc.parse(b"junk")) == [] and len(list(warc.parse(one + two[:-30]))) == 1
    chunked = warc.write_record("response", "u", None, "d", {"Transfer-Encoding": "chunked"}, b"4\r\nbody\r\n0\r\n\r\n")
    assert next(warc.parse(chunked))[6] == b"body"
    df = spark.createDataFrame([(bytearray(one + two), "x"), (None, "y")], "warc binary, type string")
    assert sorted(r["record_id"] for r in warc.read_warc(df).collect()) == ["urn:1", "urn:2"]


def test_broken_warc_bytes():
    import gzip

    one = warc.write_record("response", "urn:1", "http://x/", "d", {}, b"body" * 50)
    two = warc.write_record("response", "urn:2", "http://y/", "d", {}, b"other")
    packed = gzip.compress(one) + gzip.compress(two)
    names = lambda data: [r[0] for r in warc.parse(data)]
    assert names(packed) == ["urn:1", "urn:2"] and names(packed + b"junk") == ["urn:1", "urn:2"]
    for k in range(len(packed)):
        assert names(packed[:k]) in ([], ["urn:1"], ["urn:1", "urn:2"])
    broken = bytearray(packed)
    broken[len(gzip.compress(one)) + 15] ^= 0xFF
    assert names(bytes(broken))[:1] == ["urn:1"]
    assert names(one.replace(b"Content-Length: 2", b"Content-Length: -2") + two) == []
    assert names(one + two.replace(b"Content-Length: ", b"Content-Length: x")) == ["urn:1"]
    for body in (b"-5\r\nabc\r\n", b"zz\r\n", b"5\r\nab", b"ffffffffffff\r\nab"):
        assert len(list(warc.parse(warc.write_record("response", "u", None, "d", {"Transfer-Encoding": "chunked"}, body)))) == 1
    rng = random.Random(2)
    for _ in range(2000):
        data = bytearray(one + two if rng.random() < 0.5 else packed)
        for _ in range(3):
            data[rng.randrange(len(data))] = rng.randrange(256)
        assert len(list(warc.parse(bytes(data)))) <= 3


def test_revisits_of_odd_pages(spark):
    pages = spark.createDataFrame([(None, None, None), (1, "http://x/", ""), (1, "http://x/", ""), (2, "no url", "h")], "page_id long, url string, html string")
    records = warc.read_warc(warc.pages_to_warc(pages))
    assert records.count() == 8 and warc.read_warc(warc.pages_to_warc(pages.where("false"))).count() == 0
    cols = records.selectExpr("record_id", "type", "url", "date", "headers", "digest", "octet_length(payload) size", "sha2(payload, 256) sha256")
    assert warc.resolve_revisits(cols).count() == 8
