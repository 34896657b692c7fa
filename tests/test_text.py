"""Text operators against small Python specifications."""

import json
import random
import re

from pyspark.sql import functions as F

from lexatlas.functions import text as tx
from lexatlas.operators import hierarchy


def one(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", column.alias("y")).orderBy("i").collect()]


SPACES = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", "　"]


def test_strip_and_collapse_use_pythons_white_space(spark):
    values = [f"{s}a{s}{s}b{s}" for s in SPACES] + ["", "   ", "x"]
    assert one(spark, tx.strip("x"), *values) == [v.strip() for v in values]
    assert one(spark, tx.collapse("x"), *values) == [re.sub(r"\s+", " ", v).strip() for v in values]


def test_file_names(spark):
    values = ['a<b>:"c/\\d|?*', ". x .", "...", "第一章 函数/极限"]
    assert one(spark, tx.sanitize_filename("x"), *values) == [re.sub(r'[<>:"/\\|?*]', "_", v).strip(". ") for v in values]


def test_backslash_repair_makes_json_readable(spark):
    values = [r'{"a": "\lim x"}', r'{"a": "ok\n \"q\" \\ A"}', r'{"a": "\\\alpha"}', r'{"a": "\frac"}']
    got = one(spark, tx.repair_json_backslashes("x"), *values)
    assert [json.loads(g)["a"] for g in got] == ["\\lim x", 'ok\n "q" \\ A', "\\\\alpha", "\x0crac"]


def test_backslash_repair_random(spark):
    def spec(s):
        out, i = "", 0
        while i < len(s):
            if s[i] == "\\":
                if i + 1 < len(s) and s[i + 1] in '"\\/bfnrtu':
                    out += s[i : i + 2]
                    i += 2
                    continue
                out += "\\"
            out += s[i]
            i += 1
        return out

    rng = random.Random(5)
    values = ["".join(rng.choice('\\\\"nulx/') for _ in range(rng.randint(0, 12))) for _ in range(200)]
    assert one(spark, tx.repair_json_backslashes("x"), *values) == [spec(v) for v in values]


def test_backslash_repair_of_a_long_text(spark):
    value = '{"a": "' + r"\lim \n x " * 200_000 + '"}'
    assert json.loads(one(spark, tx.repair_json_backslashes("x"), value)[0])["a"] == "\\lim \n x " * 200_000


def test_fences_chapters_and_fallbacks(spark):
    assert one(spark, tx.strip_fences("x"), "```json\n{}\n```", "```\n{}```", "{}", " ```json{} ") == ["{}"] * 4
    assert one(spark, tx.chapters_json("x"), 'x "chapters" : [1, [2]] y', "none") == ["[1, [2]]", None]
    assert one(spark, tx.first_filled("x", F.lit("b")), "", "a", None) == ["b", "a", "b"]
    assert one(spark, tx.preview("x", 3), "abcd", "abc", None) == ["abc...", "abc", None]
    assert one(spark, tx.stem("x"), "a/b/c.d.md", "c", "/x/.md") == ["c.d", "c", ".md"]
    assert one(spark, tx.concept_code(F.length("x")), "x" * 7, "x" * 1234) == ["C007", "C1234"]


def skip_spec(t):
    patterns = [r"```[\s\S]*?```", r"\$\$[\s\S]*?\$\$", r"`[^`]+`", r"\$[^$\n]+?\$", r"!\[.*?\]\(.*?\)"]
    return sorted((m.start(), m.end()) for p in patterns for m in re.finditer(p, t))


def test_skip_ranges(spark):
    rng = random.Random(7)
    values = ["甲 $$ a $$ 函数 $x$", "```\ncode\n``` 😀 `x` ![a](b)", "a ![x\u0085](y)"]
    values += ["".join(rng.choice(["$", "$$", "`", "```", "![", "](", ")", "a", "\n", "😀", "\r", " "]) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    got = one(spark, tx.skip_ranges("x"), *values)
    assert [[(r["start"], r["end"]) for r in g] for g in got] == [skip_spec(v) for v in values]


def test_array_elements():
    cases = {
        '[1, [2, 3], {"a": "],}"}] tail': ["1", "[2, 3]", '{"a": "],}"}'], "[]": [], "[ ]": [], '["a\\"b", null]': ['"a\\"b"', "null"], '[{"a": 1}, {"b": "cut': ['{"a": 1}', '{"b": "cut'],
        "[1,": ["1"], "[": [], "[,]": ["", ""], '[{"a": {"b": [1, 2]}}, 2]': ['{"a": {"b": [1, 2]}}', "2"],
    }
    assert {t: tx.array_elements(t) for t in cases} == cases
    assert len(tx.array_elements("[" + "{\"a\": 1}," * 100_000 + "1]")) == 100_001


def test_one_broken_entry_costs_no_other(spark):
    text = '{"chapters": [{"level": 1, "编号": "1", "标题": "a"}, {"标题": "\\underline x"}, null, 7, {"level": "x"}, {"编号": "3", "标题": "b \\lim"}]}'
    df = spark.createDataFrame([(1, text), (2, "none"), (3, '{"chapters": []}'), (4, None)], "book_id int, text string")
    assert [(r["book_id"], r["ordinal"], r["title"]) for r in hierarchy.toc_entries(df).orderBy("ordinal").collect()] == [(1, 0, "a"), (1, 5, "b \\lim")]
    got = sorted(((r["book_id"], r["ordinal"], r["raw"]) for r in hierarchy.toc_rejects(df).collect()), key=str)
    assert got == sorted([(1, 1, '{"标题": "\\underline x"}'), (1, 2, "null"), (1, 3, "7"), (1, 4, '{"level": "x"}'), (2, None, "none"), (4, None, None)], key=str)
