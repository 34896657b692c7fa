import json

from lexatlas import cli
from lexatlas.sources import sinks
from lexatlas.session import Options


def stored(spark, path):
    return spark.read.parquet(sinks.current(spark, path)[1])


def test_from_book_to_answers(spark, tmp_path, capsys):
    def call(*argv):
        cli.run(cli.parser().parse_args([str(x) for x in argv]), spark, Options(threshold=0.75))
        return capsys.readouterr().out

    (tmp_path / "in").mkdir()
    structure = {"structure_summary": {"层级定义": [{"level": 1, "编号格式": "第.章"}, {"level": 2, "编号格式": "第.节"}]}, "chapters": [{"level": 1, "编号": "第一章", "title": "第一章 函数"}, {"level": 2, "编号": "第一节", "title": "第一节 映射", "父级编号": "第一章"}]}
    (tmp_path / "s.json").write_text(json.dumps(structure, ensure_ascii=False))
    (tmp_path / "in/book.md").write_text("### 第一章 函数\n## 第一节 映射\n定义 映射 是 对应\n\n例 一\n# 第二章 极限\nx\n")
    call("tree", tmp_path / "s.json", f"{tmp_path}/chapters")
    assert stored(spark, f"{tmp_path}/chapters").count() == 3
    call("toc", tmp_path / "in", tmp_path / "s.json", f"{tmp_path}/toc")
    assert stored(spark, f"{tmp_path}/toc").count() == 3
    call("normalise", tmp_path / "in", tmp_path / "s.json", tmp_path / "norm")
    assert (tmp_path / "norm/book.md").read_text().startswith("# 第一章 函数\n## 第一节 映射\n")
    call("split", tmp_path / "norm", tmp_path / "parts")
    section = tmp_path / "parts/第一章 函数/第一节 映射/第一节 映射.md"
    assert section.read_text().startswith("# 第一节 映射\n")
    call("segment", section, tmp_path / "seg.json", "--source", "b", "--section", "第一节 映射", "--chapters", f"{tmp_path}/chapters")
    got = json.loads((tmp_path / "seg.json").read_text())
    assert [s["type"] for s in got] == ["note", "example"] and {s["section_id"] for s in got} == {"3"}
    (tmp_path / "m.csv").write_text("第一节 映射/第一节 映射.md,第一节 映射\nnone.md,x\n")
    assert "none.md" in call("batch", tmp_path / "m.csv", tmp_path / "parts", tmp_path / "batch")
    segments = [{"source": "b", "title": "映射", "content": "对应", "type": "concept", "aliases": ["映 射"], "entities": "映射法"}, {"source": "b", "title": "极限", "content": "趋近", "type": "theorem"}]
    (tmp_path / "segs.json").write_text(json.dumps(segments, ensure_ascii=False))
    call("build", tmp_path / "segs.json", f"{tmp_path}/kb", "--rebuild")
    call("build", tmp_path / "segs.json", f"{tmp_path}/kb")
    call("store", tmp_path / "segs.json", f"{tmp_path}/store")
    assert stored(spark, f"{tmp_path}/store/segments").count() == 2
    assert "needs_review" in call("align", f"{tmp_path}/kb") and "auto_mapped" in call("align", f"{tmp_path}/kb", "--rerun")
    call("annotate", tmp_path / "in", tmp_path / "ann", f"{tmp_path}/kb", "--inline")
    assert "[[映射]]" in (tmp_path / "ann/book_annotated.md").read_text()
    assert "C001" in call("query", f"{tmp_path}/kb", "concepts") and "映射法" in call("query", f"{tmp_path}/kb", "alias", "法")
    assert "极限" in call("query", f"{tmp_path}/kb", "text", "极限。趋近")
    assert "assigned" in call("query", f"{tmp_path}/kb", "assign", "映射法", "C001") and "no such" in call("query", f"{tmp_path}/kb", "assign", "q", "C001")
    for what in ("aliases", "review", "counts", "metadata"):
        assert call("query", f"{tmp_path}/kb", what)
