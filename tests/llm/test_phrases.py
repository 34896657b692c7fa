import random
import re
from collections import Counter, defaultdict

import pytest

from lexatlas.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(rows, least, max_words=3, top=2000):
    """All phrases counted one by one."""
    f = defaultdict(Counter)
    for text, lang in rows:
        for words in pieces(text):
            for n in range(1, max_words + 1):
                for i in range(len(words) - n + 1):
                    f[lang or "und"][tuple(words[i : i + n])] += 1
    out = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        often = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, n, -s) for k, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "the", "The", "été", "x y", "naïve", "word", "zz", "日本"] + [f"r{k}" for k in range(40)]
    text = lambda m: "".join(rng.choices(words, [9, 8, 7, 3, 3, 2, 2, 2, 1, 1] + [0.2] * 40)[0] + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", "\x0b", ". ", "!"]) for _ in range(m))
    rows = [(text(rng.randint(0, 60)), rng.choice(["en", "fr", None, "und"])) for _ in range(n)]
    return [*rows, (None, "en"), ("", None), (" \t ", "de"), ("...", "xx"), *[("the hot line of the hot line", "en")] * 40, ("a " * 400, "en"), (text(3000), "en")]


def tuples(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize(("size", "hot", "slots"), [(1 << 22, 1 << 16, phrases.BLOCK), (50, 20, phrases.BLOCK), (700, 5, 1 << 18)])
def test_phrases_equal_brute_force(spark, monkeypatch, size, hot, slots):
    monkeypatch.setattr(phrases, "HOT_PARTS", 10**9)
    rows = random_rows(size)
    df = spark.createDataFrame([(t, g, 1, "z") for t, g in rows], "text string, lang string, n int, `a.b` string").repartition(5)
    assert tuples(phrases.collocations(df, least=4, size=size, hot=hot, slots=slots)) == brute(rows, 4)


def test_longer_phrases_and_few_ranks(spark):
    rows = random_rows(7, 60)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert tuples(phrases.collocations(df, max_words=4, least=3, top=5)) == brute(rows, 3, 4, 5)
    assert tuples(phrases.collocations(df, max_words=2, least=3)) == brute(rows, 3, 2)
    assert phrases.collocations(df.where("false")).collect() == []


def test_products_beyond_64_bits_are_exact(spark):
    a, left, right = 2_999_999_999_999, 3_000_000_000_001, 3_000_000_000_017
    got = spark.sql(f"select (cast({a}L as decimal(16,0)) * cast({a}L as decimal(16,0)) * 1000000BD) div (cast({left}L as decimal(16,0)) * cast({right}L as decimal(16,0)))").first()[0]
    assert got == 1_000_000 * a * a // (left * right)


def test_a_crowded_sketch_only_makes_fragments_longer(spark, monkeypatch):
    rows = random_rows(3, 40)
    df = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(phrases, "sketch", lambda *a: phrases.np.full((2, phrases.BLOCK), 9, "u1"))
    assert tuples(phrases.collocations(df, least=3)) == brute(rows, 3)


def test_runs_cover_each_word_once():
    texts = [b"one two. three", b"x" * 30 + b" y z", b"", b"a b c d e f g h i j k l"]
    for size in (1, 5, 9, 100):
        for reach in (0, 2, 3):
            seen = [w for words, first, last in phrases.runs(texts, reach, size) for w in words[first:last]]
            assert seen == [b"one", b"two", b"\n", b"three", b"\n", b"x" * 30, b"y", b"z", b"\n", b"\n", *b"a b c d e f g h i j k l".split(), b"\n"]


def test_fragments_are_routed_to_the_rarest_word(spark):
    words = [phrases.END, *b"of the rare of".split(), phrases.END]
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    rank = phrases.np.array([-1, 1, 0, 2])  # the, of, rare
    row, count, _ = phrases.fragments_of(words, 0, len(words), rank, number, 2)
    name = {k: w.decode() for w, k in number.items()} | {-1: ""}
    assert sorted("|".join(name[k] for k in column) for column in row.T.tolist()) == ["of|the|rare|of|", "||of|the|"]
    assert count.tolist() == [1, 1]
