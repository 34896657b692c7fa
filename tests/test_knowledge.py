"""Hierarchy, sections, concepts, alignment, search, sources, sinks, providers and streams."""

import json
import random
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from lexatlas import providers, schemas
from lexatlas.operators import align, concepts, hierarchy, search, sections
from lexatlas.session import Options
from lexatlas.sources import readers, sinks
from lexatlas.streaming import incremental

SEG = "ordinal long, source string, title string, content string, type string, aliases array<string>, entities string, created_at string"


def stored(spark, path):
    return spark.read.parquet(sinks.current(spark, path)[1])


def segs(spark, *rows):
    return spark.createDataFrame([(i, "s", t, f"c{i}", k, al, en, "T") for i, (t, k, al, en) in enumerate(rows, 1)], SEG)


def tree_spec(entries):
    """Parents by a stack of open entries, one for each level."""
    out, stack = [], {0: (1, "root")}
    for i, (level, number, parent) in enumerate(entries, 2):
        above = [stack[v] for v in sorted(stack, reverse=True) if v < level]
        to = 1
        if parent is not None:
            named = [x for x in above if x[1] == parent]
            to = (named or above or [(1, None)])[0][0]
        out.append((i, to))
        stack = {v: x for v, x in stack.items() if v < level} | {level: (i, number)}
    return out


def test_chapter_tree_random(spark):
    rng, rows, want = random.Random(2), [], {}
    for book in range(12):
        entries = [(rng.randint(book % 3 == 0 and 0 or 1, 4), rng.choice("abc"), rng.choice(["a", "b", "c", "z", "root", None])) for _ in range(60)]
        rows += [(book, k, lv, n, f"t{k}", p) for k, (lv, n, p) in enumerate(entries)]
        want[book] = [(1, None), *tree_spec(entries)]
    e = spark.createDataFrame(rows, "book_id int, ordinal long, level int, number string, title string, parent_number string")
    got: dict = {}
    for r in hierarchy.chapter_tree(e, "root").orderBy("book_id", "id").collect():
        got.setdefault(r["book_id"], []).append((r["id"], r["parent_id"]))
    assert got == want


def test_structure_file(spark, tmp_path):
    structure = {
        "structure_summary": {"层级数量": 2, "层级定义": [{"level": 1, "编号格式": "第.章", "层级名称": "章"}, {"level": 2, "编号格式": "", "层级名称": "-"}, {"level": 2, "编号格式": "第.节", "层级名称": "节"}]},
        "chapters": [{"level": 1, "编号": "第一章", "标题": "函数", "父级编号": None}, {"level": 2, "编号": "第一节", "title": r"映射 $\lim$", "标题": "", "父级编号": "第一章"}],
    }
    path = tmp_path / "s.json"
    path.write_text(json.dumps(structure, ensure_ascii=False, indent=1), encoding="utf-8")
    rules = hierarchy.heading_rules(spark, str(path))
    assert rules == [(1, "第.章"), (2, "第.节")]
    texts = readers.read_texts(spark, str(path)).withColumn("book_id", F.lit(1))
    tree = hierarchy.chapter_tree(hierarchy.toc_entries(texts), "书").orderBy("id").collect()
    assert [(r["id"], r["level"], r["number"], r["title"], r["parent_id"]) for r in tree] == [(1, 0, None, "书", None), (2, 1, "第一章", "函数", 1), (3, 2, "第一节", r"映射 $\lim$", 2)]
    md = spark.createDataFrame([(1, "### *第一章 函数*\n## 其他 **\n text\n  # 第一节 x")], "doc_id int, text string")
    assert hierarchy.normalise_headings(md, rules).first()["text"] == "# 第一章 函数\n其他\n text\n## 第一节 x"
    found = providers.toc_by_rules(spark.createDataFrame([(1, "第一章 函数\n第一节 映射\nx\n第二节 极限")], "book_id int, text string"), rules).orderBy("ordinal").collect()
    assert [(r["level"], r["number"], r["title"], r["parent_number"]) for r in found] == [(1, "第一章", "函数", None), (2, "第一节", "映射", "第一章"), (2, "第二节", "极限", "第一章")]


def test_section_lookup(spark):
    ch = spark.createDataFrame([(5, "x", "1"), (2, "x", "2"), (3, "y", "x"), (4, None, None)], "id long, title string, number string")
    names = spark.createDataFrame([("x",), ("2",), ("q",), (None,)], "section string")
    assert {r["section"]: r["section_id"] for r in hierarchy.section_lookup(names, ch).collect()} == {"x": "2", "2": "2", "q": None, None: None}


def test_sections(spark):
    book = "# 目录\n# 第一章 A\n# 第一章 A\npre\n## 一 节:\nt\n### s1\na\n### s2\nb\n## 二\nonly\n## 二\nlast\n# 第二章 B\nx"
    df = spark.createDataFrame([(1, book), (2, "# 第一章 C\n## d\ne"), (3, "nothing")], "doc_id int, text string")
    parts = {r["doc_id"]: (r["toc"], r["main"]) for r in sections.separate_toc(df).collect()}
    assert parts[1][0] == "# 目录\n# 第一章 A" and parts[1][1].startswith("# 第一章 A\npre") and parts[2][0] is None and parts[3] == (None, None)
    files = {(r["book"], r["path"]): r["content"] for r in sections.section_files(df).collect()}
    assert set(files) == {(1, f"{p}") for p in ("第一章 A/第一章 A_源文件.md", "第一章 A/一 节_/一 节_.md", "第一章 A/一 节_/s1.md", "第一章 A/一 节_/s2.md", "第一章 A/二/二.md", "第二章 B/第二章 B_源文件.md")} | {(2, "第一章 C/第一章 C_源文件.md"), (2, "第一章 C/d/d.md")}
    assert files[1, "第一章 A/二/二.md"] == "# 二\nlast" and files[1, "第一章 A/一 节_/s1.md"] == "### s1\na\n"
    # other line ends don't split, U+3000 is white space
    odd = spark.createDataFrame([(1, "a\r# b\x85# c d\n#　e\nf")], "doc_id int, text string")
    assert [r["body"] for r in sections.split_h1(odd).collect()] == []
    assert sections.split_h2(spark.createDataFrame([(1, "x\n##　e\nf")], "doc_id int, text string")).first()["title"] == "e"


def test_finished_segments(spark):
    raw = spark.createDataFrame([("s", "x", 1, " a\n b "), ("s", "q", 0, "c"), ("t", None, 5, None)], "source string, section string, idx int, content string")
    ch = spark.createDataFrame([(7, "x", "1")], "id long, title string, number string")
    got = {(r["source"], r["position"]): (r["content"], r["section_id"], r["created_at"]) for r in sections.finish_segments(raw, ch, created_at="T", model="m").collect()}
    assert got == {("s", 1): ("c", None, "T"), ("s", 2): ("a b", "7", "T"), ("t", 1): (None, None, "T")}


def test_concepts_first_wins_and_precedence(spark):
    s = segs(
        spark, ("函数", "concept", ["映射", "", None], "x, y,映射"), (" 函数 ", "theorem", ["映射", "g"], None), ("极限", "definition", None, "函数，z, "), ("", "concept", [], ""), ("n", "note", ["hidden"], "w")
    )
    got = {r["concept_id"]: (r["name"], r["content"]) for r in concepts.extract_concepts(s).collect()}
    assert got == {"C001": ("函数", "c1"), "C002": ("极限", "c3")}
    al = {r["alias"]: (r["alias_type"], r["block_id"]) for r in concepts.extract_aliases(s).collect()}
    assert al == {"映射": ("alias", 1), "x": ("entity", 1), "y": ("entity", 1), "g": ("alias", 2), "函数，z": ("entity", 3), "w": ("entity", 5)}
    s2 = s.unionByName(segs(spark, ("q", "note", [], "极限")).withColumn("ordinal", F.lit(9).cast("long")))
    _, a = concepts.build_base(s2)
    rows = {r["alias"]: (r["alias_type"], r["status"], r["concept_id"]) for r in a.collect()}
    assert rows["函数"] == ("concept", "auto_mapped", "C001") and rows["极限"] == ("entity", "pending", None)


def test_increments(spark, tmp_path):
    first, second = segs(spark, ("a", "concept", ["x"], "")), segs(spark, ("b", "concept", ["x", "y"], ""), ("a", "concept", ["z"], ""))
    folder = f"file://{tmp_path}/kb"
    incremental.increment(spark, first, folder, providers.encoder())
    incremental.increment(spark, second, folder, providers.encoder())
    once = stored(spark, f"{folder}/concepts").select("concept_id", "name").collect()
    assert sorted(map(tuple, once)) == [("C001", "a"), ("C002", "b")]
    n = stored(spark, f"{folder}/aliases").count()
    incremental.increment(spark, second, folder)
    assert stored(spark, f"{folder}/aliases").count() == n == 5
    assert all(r["violations"] == 0 for r in schemas.constraint_report(stored(spark, f"{folder}/concepts"), stored(spark, f"{folder}/aliases")).collect())


def test_stream_of_increments(spark, tmp_path):
    segs(spark, ("a", "concept", ["x"], "e1"), ("b", "theorem", [], "e2")).write.parquet(f"{tmp_path}/in")
    q = incremental.follow(spark.readStream.schema(SEG).parquet(f"{tmp_path}/in"), f"file://{tmp_path}/kb", f"{tmp_path}/cp")
    q.awaitTermination(120)
    assert stored(spark, f"{tmp_path}/kb/concepts").count() == 2
    assert stored(spark, f"{tmp_path}/kb/aliases").count() == 5


def test_decisions(spark):
    vec = {"a": [1.0, 0.0], "b": [0.8, 0.6], "far": [0.0, 1.0], "neg": [-1.0, 0.0], "none": None, "zero": [0.0, 0.0], "mid": [1.0, 0.0]}
    kinds = {"a": "alias", "b": "entity", "far": "alias", "neg": "entity", "none": "entity", "zero": "entity", "mid": "entity"}
    rows = [(k, 1, None, kinds[k], "", 0.0, "pending", None, "", v) for k, v in vec.items()] + [("kept", 1, "C9", "alias", "", 0.5, "auto_mapped", "r", "", [1.0, 0.0])]
    al = spark.createDataFrame(rows, schemas.ALIASES)
    co = spark.createDataFrame([("C001", "b", "", "", "t", "concept", "", [1.0, 0.0]), ("C002", "same", "", "", "t", "concept", "", [2.0, 0.0])], schemas.CONCEPTS)
    got = {r["alias"]: r for r in align.align(al, co, providers.rule_judge).collect()}
    seen = {k: (r["status"], r["concept_id"], round(r["confidence"], 6)) for k, r in got.items()}
    assert seen == {
        "a": ("auto_mapped", "C001", 1.0), "b": ("llm_confirmed", "C001", 0.8), "far": ("needs_review", None, 0.0), "neg": ("needs_review", None, 0.0), "none": ("unmapped", None, 0.0),
        "zero": ("needs_review", None, 0.0), "mid": ("needs_review", None, 1.0), "kept": ("auto_mapped", "C9", 0.5),
    }
    assert got["far"]["llm_reason"] == "向量相似度不足(0.000<0.75)" and got["neg"]["llm_reason"] == "无匹配概念" and got["mid"]["llm_reason"] == "LLM:无关联|rule"
    again = {r["alias"]: r["status"] for r in align.align(spark.createDataFrame(list(got.values()), schemas.ALIASES), co, providers.rule_judge, rerun=True).collect()}
    assert again == {k: v[0] for k, v in seen.items()}
    assert align.outcome_counts(spark.createDataFrame(list(got.values()), schemas.ALIASES)).first().asDict() == {"auto_mapped": 2, "llm_confirmed": 1, "llm_rejected": 1, "needs_review": 3, "unmapped": 1}


def test_judges(spark):
    asked = spark.createDataFrame([("a", "b", "c"), ("x", "b", "c"), ("e", "b", "c")], "alias string, name string, content string")
    ask = lambda a, n, c: {"a": '```json\n{"decision": "中关联", "reason": "r"}\n```', "x": "junk"}[a]
    got = {r["alias"]: r["decision"] for r in providers.reply_judge(ask)(asked).collect()}
    assert got == {"a": "中关联", "x": "无关联", "e": "无关联"}


def test_search(spark):
    co = spark.createDataFrame([(f"C{i:03d}", f"n{i}", "", "", "t" * 300, "concept", "", v) for i, v in enumerate([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], None, []])], schemas.CONCEPTS)
    assert [(r["concept_id"], round(r["similarity"], 3)) for r in search.search_vectors(co, [1.0, 0.0], 2).collect()] == [("C000", 1.0), ("C001", 1.0)]
    assert len(search.search_text(co, "q", lambda q: [0.0, 1.0], 1).first()["content"]) == 203
    al = spark.createDataFrame([("Ab%", 1, "C000", "alias", "", 0.8, "needs_review", "r", "", None), ("abx", 1, None, "entity", "", 0.9, "needs_review", None, "", None)], schemas.ALIASES)
    assert [r["alias"] for r in search.search_alias(al, co, "B%").collect()] == ["abx", "Ab%"]
    assert [r["line"] for r in search.displayed(search.list_aliases(al, co)).collect()] == ["? 'Ab%' (alias) → [C000] n0 [needs_review] conf=0.800", "? 'abx' (entity) → (无匹配) [needs_review] conf=0.900"]
    assert search.list_aliases(al, co, "pending").count() == 0 and search.needs_review(al, co).count() == 2
    done, ok = search.manual_assign(al, co, "abx", "C001")
    assert ok and {r["alias"]: r["status"] for r in done.collect()} == {"Ab%": "needs_review", "abx": "llm_confirmed"}
    assert not search.manual_assign(al, co, "abx", "C999")[1] and not search.manual_assign(al, co, "nope", "C001")[1]


def test_search_many_in_groups(spark):
    rng = random.Random(4)
    vectors = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(80)] + [[1.0, 0.0]] * 3 + [[0.0] * 3, None, []] + [[2.0, 0.0, 0.0]] * 30
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, embedding array<double>")
    from lexatlas.functions import vectors as fv

    unit = lambda v: [x / (sum(y * y for y in v) ** 0.5 or 1) for x in v]
    want = []
    for i, v in enumerate(vectors):
        if v and i % 3 == 0:
            scores = sorted((-round(sum(a * b for a, b in zip(unit(v), unit(w), strict=True)), 9), j) for j, w in enumerate(vectors) if w and len(w) == len(v))[:4]
            want += [(i, j, -s, r) for r, (s, j) in enumerate(scores, 1)]
    for size, group in ((8, 2), (2048, 4)):
        old = fv.blocks.__defaults__, fv.meet.__defaults__
        fv.blocks.__defaults__, fv.meet.__defaults__ = (size,), (group,)
        try:
            got = search.search_many(rows.where("i % 3 = 0"), rows, 4, query_key="i", key="i").toDF("q", "k", "s", "r").collect()
        finally:
            fv.blocks.__defaults__, fv.meet.__defaults__ = old
        assert sorted((r["q"], r["k"], round(r["s"], 6) + 0.0, r["r"]) for r in got) == sorted((q, k, round(s, 6) + 0.0, r) for q, k, s, r in want)
    assert search.search_many(rows.where("false"), rows, 4, query_key="i", key="i").count() == 0


def test_stored_versions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    table = lambda *keys: spark.createDataFrame([(k, "1") for k in keys], schemas.METADATA)
    values = lambda: {r["key"] for r in readers.read_table(spark, path, schemas.METADATA).collect()}
    names = lambda: sorted(x.name for x in (tmp_path / "t").iterdir() if not x.name.startswith("."))
    assert values() == set()
    sinks.overwrite(table("a"), path)
    old = readers.read_table(spark, path, schemas.METADATA)
    sinks.overwrite(old.union(table("b")), path)
    assert values() == {"a", "b"} and {r["key"] for r in old.collect()} == {"a"} and sinks.current(spark, path)[0] == 2
    (tmp_path / "t" / "_left").mkdir()  # of a process that ended before its rename
    sinks.overwrite(table("c"), path)
    assert values() == {"c"} and names() == ["_left", "v0000000002", "v0000000003"]


def test_a_plain_folder_of_files_is_a_stored_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([("a", "1")], schemas.METADATA).write.parquet(path)
    assert readers.read_table(spark, path, schemas.METADATA).count() == 1 and sinks.current(spark, path) == (0, path)
    sinks.overwrite(readers.read_table(spark, path, schemas.METADATA).union(spark.createDataFrame([("b", "1")], schemas.METADATA)), path)
    assert readers.read_table(spark, path, schemas.METADATA).count() == 2


def test_readers_and_writers_meet(spark, tmp_path, monkeypatch):
    """A reader that comes between the steps of a writer, and two writers of which one gets an error and none is lost."""
    path = f"file://{tmp_path}/t"
    table = lambda *keys: spark.createDataFrame([(k, "1") for k in keys], schemas.METADATA)
    values = lambda: {r["key"] for r in readers.read_table(spark, path, schemas.METADATA).collect()}
    sinks.overwrite(table("old"), path)
    real, seen = sinks._commit, []

    def between(s, made, target):
        seen.append(values())
        if len(seen) == 1:
            sinks.overwrite(table("first"), path)
        real(s, made, target)
        seen.append(values())

    monkeypatch.setattr(sinks, "_commit", between)
    with pytest.raises(OSError, match="another writer"):
        sinks.overwrite(table("second"), path)
    monkeypatch.setattr(sinks, "_commit", real)
    assert values() == {"first"} and seen == [{"old"}, {"old"}, {"first"}]
    at = sinks.current(spark, path)[0]
    sinks.overwrite(table("x"), path, at)
    with pytest.raises(OSError, match="another writer"):
        sinks.overwrite(table("y"), path, at)
    assert values() == {"x"} and not [x for x in (tmp_path / "t").iterdir() if x.name.startswith("_")]


def test_vectors_that_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [1.0, 1.0]), (4, [1.0, None]), (5, [1.0]), (6, None), (7, []), (8, [float("inf"), 0.0]), (9, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "concept_id int, embedding array<double>")
    assert [r["concept_id"] for r in search.search_vectors(df, [1.0, 0.0]).collect()] == [1, 3, 9]
    assert search.search_vectors(df, [float("nan"), 0.0]).collect() == []
    q = spark.createDataFrame([(0, [1.0, 0.0]), (-1, [float("nan"), 0.0]), (-2, [1.0, None])], "q int, embedding array<double>")
    many = search.search_many(q, df, 5, query_key="q", key="concept_id").collect()
    assert sorted((r["q"], r["rank"], r["concept_id"]) for r in many) == [(0, 1, 1), (0, 2, 3), (0, 3, 9)]
    best = align.best_match(q.withColumnRenamed("q", "alias"), df).collect()
    assert [(r["alias"], r["best"]) for r in best] == [(0, 1)]


def test_dense_numbers(spark):
    from lexatlas.functions.numbering import dense_numbers

    rng = random.Random(1)
    values = rng.sample(range(10**12), 5000)
    got = dense_numbers(spark.createDataFrame([(v,) for v in values], "x long").repartition(7), "n", "x").collect()
    assert sorted((r["x"], r["n"]) for r in got) == list(zip(sorted(values), range(1, 5001), strict=True))
    assert dense_numbers(spark.createDataFrame([], "x long"), "n", "x").count() == 0


def test_records_of_several_files(spark, tmp_path):
    for name, text in (("a.json", '[{"title": "x"}, {"title": "y"}]'), ("b.json", '[{"title": "z"}]'), ("c.json", ""), ("d.json", "{")):
        (tmp_path / name).write_text(text)
    got = readers.read_json_array(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["title"]) for r in got] == [(1, "x"), (2, "y"), (3, "z")]
    assert {r["path"].rpartition("/")[2] for r in readers.broken_json(spark, str(tmp_path)).collect()} >= {"d.json"}


def test_listed_texts(spark):
    texts = spark.createDataFrame([("file:/r/a/x.md", "1"), ("file:/r/b/x.md", "2"), ("file:/r/y.md", "3"), ("file:/r/zy.md", "4")], "path string, text string")
    listed = spark.createDataFrame([("x.md", "s"), ("b/x.md", "t"), ("y.md", "u"), ("none.md", "v"), (None, "w")], "file string, section string")
    assert {r["section"]: r["text"] for r in sections.listed_texts(listed, texts).collect()} == {"s": "1", "t": "2", "u": "3", "v": None, "w": None}


def test_sqlite_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.5, True, [1.0, -2.5], ["x", "y"]), (2, None, None, None, None, None)], "i long, t string, d double, b boolean, v array<float>, l array<string>")
    assert sinks.write_sqlite(df, str(tmp_path / "x.db"), "my table") == 2
    got = {r["i"]: r for r in readers.float_vectors(readers.read_sqlite(spark, str(tmp_path / "x.db"), "my table", 2), "v").collect()}
    assert (got[1]["t"], got[1]["d"], got[1]["b"], got[1]["v"], got[1]["l"]) == ("a", 0.5, 1, [1.0, -2.5], '["x","y"]') and got[2]["v"] is None


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"title": "x", "type": "note"}, {"title": null}]')
    assert [(r["ordinal"], r["title"]) for r in readers.read_json_array(spark, str(tmp_path / "a.json")).orderBy("ordinal").collect()] == [(1, "x"), (2, None)]
    (tmp_path / "bad.json").write_text("not json")
    assert readers.broken_json(spark, str(tmp_path / "bad.json")).count() == 1
    db = sqlite3.connect(tmp_path / "k.db")
    db.execute("CREATE TABLE concepts (concept_id TEXT PRIMARY KEY, n INTEGER, r REAL, embedding BLOB)")
    db.executemany("INSERT INTO concepts VALUES (?, ?, ?, ?)", [(f"C{i}", i, i / 2, struct.pack("<2f", i, 1)) for i in range(10)])
    db.commit()
    got = readers.float_vectors(readers.read_sqlite(spark, str(tmp_path / "k.db"), "concepts", 3))
    assert sorted((r["concept_id"], r["n"], r["r"], r["embedding"]) for r in got.collect()) == [(f"C{i}", i, i / 2, [float(i), 1.0]) for i in range(10)]
    sinks.write_texts(spark.createDataFrame([("x/y.md", "t\r\n"), ("z.md", "z")], "path string, content string"), str(tmp_path / "out"))
    assert (tmp_path / "out/x/y.md").read_bytes() == b"t\r\n"
    assert readers.read_texts(spark, f"{tmp_path}/out", "*.md", recursive=True).count() == 2
    with pytest.raises(Exception, match="leaves the folder"):
        sinks.write_texts(spark.createDataFrame([("../evil.md", "")], "path string, content string"), str(tmp_path / "out"))
    path = f"file://{tmp_path}/t"
    sinks.overwrite(spark.createDataFrame([("a", "1")], schemas.METADATA), path)
    sinks.overwrite(sinks.metadata_upsert(stored(spark, path), {"a": "2", "b": "3"}), path)
    assert {r["key"]: r["value"] for r in stored(spark, path).collect()} == {"a": "2", "b": "3"}
    text = sinks.json_array(spark.createDataFrame([(2, "b"), (1, "函")], "o int, t string"), "o").first()["value"]
    assert json.loads(text) == [{"t": "函"}, {"t": "b"}]
    legacy = spark.createDataFrame([(1, "第一节", None, "example", "t", "c", "a, b", "x,y")], schemas.LEGACY_SEGMENT)
    assert schemas.legacy_segments(legacy).first()["aliases"] == ["a", "b"]


def test_providers_and_options(spark, tmp_path):
    assert providers.hashed_vector("abc") == providers.hashed_vector("abc") and providers.hashed_vector("") == [0.0] * providers.DIM
    sec = spark.createDataFrame([("s", "x", "# 定义 a\nt\n\n定理 b\n\n  \n\nc")], "source string, section string, text string")
    assert [r["type"] for r in providers.segments_by_paragraph(sec).orderBy("idx").collect()] == ["definition", "theorem", "note"]
    env = tmp_path / ".env"
    env.write_text("LEXATLAS_TOP_K=7\n# x\nKEY='v'\n")
    o = Options.load(str(env), threshold=0.5)
    assert (o.top_k, o.threshold, o.extra["KEY"]) == (7, 0.5, "v")
    store = concepts.knowledge_segments(segs(spark, ("a", "note", [], ""), ("b", "note", [], "")), providers.encoder())
    assert [(r["id"], r["title"], len(r["embedding"])) for r in store.orderBy("id").collect()] == [(1, "a", providers.DIM), (2, "b", providers.DIM)]
    assert {r["key"]: r["value"] for r in concepts.metadata(segs(spark, ("a", "note", [], "")), "m").collect()} == {"embedding_model": "m", "created_at": "", "total_segments": "1"}


def test_chapter_tree_of_many_levels(spark):
    rows = [(1, k, k + 1, str(k), f"t{k}", str(k - 1) if k else None) for k in range(12)] + [(1, 12, 8, "x", "x", "nowhere")]
    e = spark.createDataFrame(rows, "book_id int, ordinal long, level int, number string, title string, parent_number string")
    parent = {r["id"]: r["parent_id"] for r in hierarchy.chapter_tree(e).collect()}
    assert parent == {1: None, 2: 1, **{k + 2: k + 1 for k in range(1, 12)}, 14: 8}
    assert hierarchy.chapter_tree(e.where("false")).count() == 0
