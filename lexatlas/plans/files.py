"""Registered queries of sources, sinks, books and providers. Each writes what it reads to the shared scratch folder first, in the
format that the source is for; the DuckDB twin tells what should come back."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas import providers
from lexatlas.functions import text as tx
from lexatlas.operators import concepts, hierarchy, sections
from lexatlas.plans import adapters as ad
from lexatlas.schemas import METADATA
from lexatlas.scratch import scratch_path
from lexatlas.sources import readers, sinks

RULES = [(1, "conv"), (2, "user"), (3, "assistant|system")]
#: Fixed values of a book's headings.
FIRST, CONTENTS = "第一章", "目录"


def text_files(s: SparkSession, d: str) -> DataFrame:
    """Texts written as files of two levels of folders and read back by name."""
    folder = scratch_path(s, "texts")
    b = ad.read(s, d, "benchmark")
    sinks.write_texts(b.select(F.concat(F.lit("part "), F.pmod("item_id", F.lit(3)), F.lit("/"), F.col("item_id"), F.lit(".md")).alias("path"), F.col("text").alias("content")), folder)
    return readers.read_texts(s, folder, "*.md", recursive=True).select("name", "text")


def json_records(s: SparkSession, d: str) -> DataFrame:
    """Customers as a JSON array for each nation, read back as records with their place in all files."""
    folder = scratch_path(s, "arrays")
    c = ad.read(s, d, "customer").select("c_nationkey", "c_custkey", F.col("c_name").alias("title"), F.col("c_mktsegment").alias("content"), F.col("c_acctbal").alias("confidence"))
    arrays = sinks.json_array(c, "c_custkey", by="c_nationkey")
    sinks.write_texts(arrays.select(F.concat(F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.lit(".json")).alias("path"), F.col("value").alias("content")), folder)
    return readers.read_json_array(s, folder).select("ordinal", "title", "content", "confidence")


def json_rejects(s: SparkSession, d: str) -> DataFrame:
    """Files that don't parse, with what they hold."""
    folder = scratch_path(s, "rejects")
    n = ad.read(s, d, "nation")
    good = F.to_json(F.array(F.struct(F.col("n_name").alias("title"))))
    content = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("[{broken "), F.col("n_name"))).otherwise(good)
    sinks.write_texts(n.select(F.concat(F.col("n_nationkey"), F.lit(".json")).alias("path"), content.alias("content")), folder)
    return readers.broken_json(s, folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "raw")


def toc_json(s: SparkSession, d: str) -> DataFrame:
    """The array behind "chapters" in a text for each region, with noise around it, lone backslashes and titles under two keys."""
    n = ad.read(s, d, "nation").join(ad.read(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    own = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("\\lim "), F.col("n_name"))).otherwise("")
    parent = F.when(F.col("n_nationkey") % 5 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), F.col("r_name"), F.lit('"')))
    entry = F.concat(F.lit('{"level": 2, "编号": "'), F.col("n_name"), F.lit('", "标题": "'), own, F.lit('", "title": "t '), F.col("n_name"), F.lit('", "父级编号": '), parent, F.lit("}"))
    entries = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", entry.alias("e")))), lambda x: x["e"]), ",\n")
    texts = n.groupBy(F.col("n_regionkey").alias("book_id")).agg(F.concat(F.lit('```json\n{"structure_summary": {}, "chapters" : ['), entries, F.lit("]\n}\n```")).alias("text"))
    return hierarchy.toc_entries(texts)


def damaged_toc(s: SparkSession, d: str) -> DataFrame:
    """The contents of each region: every fourth nation's entry has an escape that JSON doesn't have, the last region's text breaks off inside its
    last entry, and a text without contents for each supplier of region 0."""
    n = ad.read(s, d, "nation")
    own = F.when(F.col("n_nationkey") % 4 == 1, "\\underline ").otherwise("a [b], {c} \\\"d\\\" ")
    entry = F.concat(F.lit('{"level": 2, "编号": "'), F.col("n_nationkey"), F.lit('", "标题": "'), own, F.col("n_name"), F.lit('"}'))
    entries = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", entry.alias("e")))), lambda x: x["e"]), ",")
    end = F.when(F.col("n_regionkey") == 4, ', {"level": 2, "编号": "cut').otherwise("]} and more [text]")
    books = n.groupBy("n_regionkey").agg(entries.alias("entries")).select(F.col("n_regionkey").cast("long").alias("book_id"), F.concat(F.lit('{"chapters": ['), F.col("entries"), end).alias("text"))
    none = ad.read(s, d, "supplier").select((F.lit(-1) - F.col("s_suppkey")).cast("long").alias("book_id"), F.concat(F.lit("no contents of "), F.col("s_name")).alias("text"))
    return books.unionByName(none)


def toc_salvage(s: SparkSession, d: str) -> DataFrame:
    """What can be read of damaged contents."""
    return hierarchy.toc_entries(damaged_toc(s, d)).select("book_id", "ordinal", "level", "number", "title")


def toc_rejects(s: SparkSession, d: str) -> DataFrame:
    """What can't, and where."""
    return hierarchy.toc_rejects(damaged_toc(s, d))


def sqlite_scan(s: SparkSession, d: str) -> DataFrame:
    """Vectors exported to an SQLite file, scanned in ranges of its rowid."""
    path = scratch_path(s, "vectors").removeprefix("file://") + ".db"
    e = ad.read(s, d, "embeddings").select("vec_id", "label", "embedding")
    from pathlib import Path

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    sinks.write_sqlite(e, path, "vectors")
    got = readers.float_vectors(readers.read_sqlite(s, path, "vectors", 4))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return got.select("vec_id", F.col("label").cast("int").alias("label"), F.size("embedding").alias("n"), F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"), F.round(total, 5).alias("total"))


def stored_tables(s: SparkSession, d: str) -> DataFrame:
    """A table read where there is none, built anew, replaced by what reads it, and read."""
    path = scratch_path(s, "stored")
    none = readers.read_table(s, path, METADATA)
    n = ad.read(s, d, "nation").select(F.concat(F.lit("nation-"), F.col("n_nationkey")).alias("key"), F.col("n_name").alias("value"))
    sinks.overwrite(n.unionByName(none), path)
    sinks.overwrite(sinks.metadata_upsert(readers.read_table(s, path, METADATA), {"nation-3": "new", "other": "o"}), path)
    return readers.read_table(s, path, METADATA)


def base_metadata(s: SparkSession, d: str) -> DataFrame:
    return concepts.metadata(ad.segments(s, d), "some-model")


def books(s: SparkSession, d: str) -> DataFrame:
    """A book for each region: contents, then its nations as chapters, their customers' segments as sections, balances as subsections; a
    balance that comes again in a section makes a heading again."""
    n, c = ad.read(s, d, "nation"), ad.read(s, d, "customer")
    joined = lambda key, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, F.col(value).alias("v")))), lambda x: x["v"]), "")
    sub = F.concat(F.lit("### b"), F.floor(F.col("c_acctbal") / 1000).cast("string"), F.lit("\n"), F.col("c_name"), F.lit("\n"))
    sec = c.withColumn("sub", sub).groupBy("c_nationkey", "c_mktsegment").agg(joined("c_custkey", "sub").alias("subs"))
    sec = sec.withColumn("sec", F.concat(F.lit("## "), F.col("c_mktsegment"), F.lit("\n"), F.col("subs"))).groupBy("c_nationkey").agg(joined("c_mktsegment", "sec").alias("secs"))
    first = F.row_number().over(W.partitionBy("n_regionkey").orderBy("n_nationkey")) == 1
    n = n.withColumn("title", F.concat(F.when(first, f"{FIRST} ").otherwise("章 "), F.col("n_name"))).join(sec, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    chapter = F.concat(F.lit("# "), F.col("title"), F.lit("\npre "), F.col("n_name"), F.lit("\n"), F.coalesce("secs", F.lit("")))
    main = n.withColumn("chapter", chapter).groupBy("n_regionkey").agg(joined("n_nationkey", "chapter").alias("main"), F.min_by("title", "n_nationkey").alias("title"))
    return main.select(F.col("n_regionkey").alias("doc_id"), F.concat(F.lit(f"# {CONTENTS}\n# "), F.col("title"), F.lit("\n"), F.col("main")).alias("text"))


BOOKS_SQL = f"""
sub AS (SELECT c_nationkey, c_mktsegment, c_custkey, 'b' || floor(c_acctbal / 1000)::BIGINT AS name, '### b' || floor(c_acctbal / 1000)::BIGINT || chr(10) || c_name || chr(10) AS body FROM customer),
sec AS (SELECT c_nationkey, c_mktsegment, '## ' || c_mktsegment || chr(10) || string_agg(body, '' ORDER BY c_custkey) AS body FROM sub GROUP BY c_nationkey, c_mktsegment),
secs AS (SELECT c_nationkey, string_agg(body, '' ORDER BY c_mktsegment) AS secs FROM sec GROUP BY c_nationkey),
chap AS (
  SELECT n_regionkey, n_nationkey, CASE WHEN row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) = 1 THEN '{FIRST} ' ELSE '章 ' END || n_name AS title,
    'pre ' || n_name || chr(10) || coalesce(secs, '') AS rest FROM nation LEFT JOIN secs ON c_nationkey = n_nationkey
),
book AS (SELECT n_regionkey AS doc_id, arg_min(title, n_nationkey) AS first, string_agg('# ' || title || chr(10) || rest, '' ORDER BY n_nationkey) AS main FROM chap GROUP BY n_regionkey)"""


def contents_separation(s: SparkSession, d: str) -> DataFrame:
    """The contents of a book apart from its text; the second region's books have no contents, the third's no first chapter."""
    b = books(s, d)
    cut = F.when(F.col("doc_id") == 1, F.regexp_replace("text", r"^# .*\n# .*\n", "")).when(F.col("doc_id") == 2, F.regexp_replace("text", FIRST, "x")).otherwise(F.col("text"))
    return sections.separate_toc(b.withColumn("text", cut)).select("doc_id", "toc", "main")


def section_files(s: SparkSession, d: str) -> DataFrame:
    return sections.section_files(books(s, d))


def toc_rules(s: SparkSession, d: str) -> DataFrame:
    return providers.toc_by_rules(ad.markdown(s, d), RULES, book="doc_id")


def paragraph_segments(s: SparkSession, d: str) -> DataFrame:
    """Documents cut into segments by paragraph and finished with section ids, positions and constants."""
    docs = ad.read(s, d, "documents").join(ad.read(s, d, "nation"), F.pmod("doc_id", F.lit(25)) == F.col("n_nationkey"))
    files = docs.select(F.col("doc_id").cast("string").alias("source"), F.concat(F.lit("t "), F.col("n_name")).alias("section"), "text")
    tree = hierarchy.chapter_tree(ad.toc(s, d), "book")
    done = sections.finish_segments(providers.segments_by_paragraph(files), tree, created_at="2024-01-01T00:00:00", model="m", version=2)
    return done.select("source", "position", "section_id", "title", "content", "type", "created_at", "model", "version")


def encoder_units(s: SparkSession, d: str) -> DataFrame:
    """The default encoder's vectors: how many components, and their length."""
    v = ad.read(s, d, "part").select("p_partkey", providers.encoder()(F.col("p_name")).alias("v"))
    return v.select("p_partkey", F.size("v").alias("n"), F.round(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), 4).alias("length"))


def judge_rules(s: SparkSession, d: str) -> DataFrame:
    """The default judge, and one that replies in JSON: fenced, bare, or not at all."""
    e = ad.read(s, d, "events")
    name = F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("the "), F.col("event_type"))).otherwise("zz")
    asked = e.select(F.concat_ws("-", "event_type", F.col("event_id") % 3).alias("key"), F.col("event_type").alias("alias"), name.alias("name"), F.lit("c").alias("content")).distinct()

    def ask(alias: str, name: str, content: str) -> str:
        if name == "zz":
            raise ValueError("no answer")
        reply = json.dumps({"decision": "高关联" if name == alias.upper() else "中关联", "reason": f"{alias} {content}"}, ensure_ascii=False)
        return f"```json\n{reply}\n```" if name.startswith("the") else reply

    rule = providers.rule_judge(asked).select("key", F.col("decision").alias("by_rule"))
    said = providers.reply_judge(ask)(asked).select("key", F.col("decision").alias("by_reply"), F.col("reason").alias("why"))
    return rule.join(said, "key")


def batch_files(s: SparkSession, d: str) -> DataFrame:
    """Files of a manifest, found by the end of their paths."""
    n = ad.read(s, d, "nation").join(ad.read(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    texts = n.select(F.concat(F.lit("file:/books/"), F.col("r_name"), F.lit("/"), F.col("n_name"), F.lit(".md")).alias("path"), F.concat(F.lit("text of "), F.col("n_name")).alias("text"))
    file = F.when(F.col("n_nationkey") % 3 == 0, F.concat("r_name", F.lit("/"), "n_name", F.lit(".md"))).when(F.col("n_nationkey") % 3 == 1, F.concat("n_name", F.lit(".md"))).otherwise(F.concat(F.substring("n_name", 2, 99), F.lit(".md")))
    listed = n.select(file.alias("file"), F.col("n_name").alias("section"))
    more = readers.manifest(s, [("ASIA/none.md", "x")]).withColumnRenamed("path", "file")
    return sections.listed_texts(listed.unionByName(more), texts)


def iso_times(s: SparkSession, d: str) -> DataFrame:
    return ad.read(s, d, "events").select("event_id", tx.iso_time("ts").alias("at"))


def path_names(s: SparkSession, d: str) -> DataFrame:
    n = ad.read(s, d, "nation").withColumn("path", F.concat(F.lit("a/b.c/"), F.col("n_name"), F.lit(".v1.json")))
    return n.select("n_nationkey", tx.stem("path").alias("stem"), tx.pretty_path("path").alias("pretty"))


def fixed_decimals(s: SparkSession, d: str) -> DataFrame:
    return ad.read(s, d, "customer").select("c_custkey", tx.fixed("c_acctbal").alias("shown"))


def tree_levels(s: SparkSession, d: str) -> DataFrame:
    """Entries of nine levels in any order; parents by number, by the root's title, unknown, or none."""
    c = ad.read(s, d, "customer")
    k = F.col("c_custkey")
    parent = F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, F.concat(F.lit("n"), k % 5)).when(k % 4 == 2, F.lit("book")).otherwise("nowhere")
    e = c.select(F.col("c_nationkey").alias("book_id"), k.alias("ordinal"), (1 + k * 7 % 9).cast("int").alias("level"), F.concat(F.lit("n"), k % 7).alias("number"), F.col("c_name").alias("title"), parent.alias("parent_number"))
    return hierarchy.chapter_tree(e, "book").select("book_id", "id", "level", "number", "title", "parent_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        text_files, json_records, json_rejects, toc_json, toc_salvage, toc_rejects, sqlite_scan, stored_tables, base_metadata, contents_separation, section_files, toc_rules, paragraph_segments, encoder_units, judge_rules, batch_files, iso_times,
        path_names, fixed_decimals, tree_levels,
    )
}

_WS = ad.WS_SQL
_BARE = lambda x: rf"regexp_replace(regexp_replace(regexp_replace({ad.strip_sql(x)}, '^#+{_WS}*', ''), '^\*+{_WS}*', ''), '{_WS}*\*+$', '')"

ORACLES: dict[str, str] = {
    "text_files": "SELECT item_id || '.md' AS name, text FROM benchmark WHERE text <> ''",
    "json_records": "SELECT row_number() OVER (ORDER BY c_nationkey, c_custkey) AS ordinal, c_name AS title, c_mktsegment AS content, c_acctbal AS confidence FROM customer",
    "json_rejects": "SELECT n_nationkey || '.json' AS name, '[{broken ' || n_name AS raw FROM nation WHERE n_nationkey % 3 = 0",
    "toc_salvage": r"""SELECT n_regionkey::BIGINT AS book_id, ordinal, 2 AS level, n_nationkey::VARCHAR AS number, 'a [b], {c} "d" ' || n_name AS title
      FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS ordinal FROM nation) WHERE n_nationkey % 4 <> 1""",
    "toc_rejects": r"""SELECT n_regionkey::BIGINT AS book_id, ordinal, '{"level": 2, "编号": "' || n_nationkey || '", "标题": "\underline ' || n_name || '"}' AS raw
      FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS ordinal FROM nation) WHERE n_nationkey % 4 = 1
      UNION ALL SELECT 4, count(*), '{"level": 2, "编号": "cut' FROM nation WHERE n_regionkey = 4 HAVING count(*) > 0
      UNION ALL SELECT -1 - s_suppkey, NULL, 'no contents of ' || s_name FROM supplier""",
    "toc_json": r"""SELECT n_regionkey AS book_id, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS ordinal, 2 AS level, n_name AS number,
      CASE WHEN n_nationkey % 2 = 0 THEN '\lim ' || n_name ELSE 't ' || n_name END AS title, CASE WHEN n_nationkey % 5 <> 0 THEN r_name END AS parent_number FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "sqlite_scan": "SELECT vec_id, label, len(embedding)::INT AS n, round(embedding[1]::DOUBLE, 6) AS first, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings",
    "stored_tables": "SELECT 'nation-' || n_nationkey AS key, CASE WHEN n_nationkey = 3 THEN 'new' ELSE n_name END AS value FROM nation UNION ALL SELECT 'other', 'o'",
    "base_metadata": f"WITH {ad.SEGMENTS_SQL} SELECT 'embedding_model' AS key, 'some-model' AS value UNION ALL SELECT 'created_at', '' UNION ALL SELECT 'total_segments', count(*)::VARCHAR FROM seg",
    "contents_separation": f"""WITH {BOOKS_SQL}
      SELECT doc_id, CASE WHEN doc_id NOT IN (1, 2) THEN '# {CONTENTS}' || chr(10) || '# ' || first END AS toc, CASE WHEN doc_id <> 2 THEN rtrim(main, chr(10)) END AS main FROM book""",
    "section_files": f"""WITH {BOOKS_SQL},
      c AS (SELECT n_regionkey AS book, n_nationkey AS c_nationkey, title, rtrim('# ' || title || chr(10) || rest, chr(10)) AS body FROM chap),
      s AS (SELECT book, title, c_nationkey, c_mktsegment, c_mktsegment = max(c_mktsegment) OVER (PARTITION BY c_nationkey) AS last, body FROM sec JOIN (SELECT book, title, c_nationkey FROM c) USING (c_nationkey)),
      u AS (SELECT book, title, x.c_mktsegment, x.name, x.body, s.last AND x.c_custkey = max(x.c_custkey) OVER (PARTITION BY x.c_nationkey, x.c_mktsegment) AS last, x.c_custkey FROM sub x JOIN s USING (c_nationkey, c_mktsegment))
      SELECT book, title || '/' || title || '_源文件.md' AS path, body AS content FROM c
      UNION ALL SELECT book, title || '/' || c_mktsegment || '/' || c_mktsegment || '.md', CASE WHEN last THEN rtrim(body[2:], chr(10)) ELSE body[2:] END FROM s
      UNION ALL SELECT book, title || '/' || c_mktsegment || '/' || name || '.md', CASE WHEN last THEN rtrim(body, chr(10)) ELSE body END FROM u
        QUALIFY row_number() OVER (PARTITION BY book, title, c_mktsegment, name ORDER BY c_custkey DESC) = 1""",
    "toc_rules": rf"""WITH {ad.MD_LINES_SQL}, b AS (SELECT doc_id, pos - 1 AS ordinal, {_BARE("line")} AS bare FROM ml),
      l AS (SELECT *, CASE WHEN regexp_matches(bare, '^conv') THEN 1 WHEN regexp_matches(bare, '^user') THEN 2 WHEN regexp_matches(bare, '^(assistant|system)') THEN 3 END AS level,
        regexp_extract(bare, '^(conv|user|assistant|system)') AS number FROM b),
      e AS (SELECT * FROM l WHERE level IS NOT NULL),
      w AS (SELECT *, last_value(CASE WHEN level = 1 THEN number END IGNORE NULLS) OVER p AS n1, last_value(CASE WHEN level = 2 THEN number END IGNORE NULLS) OVER p AS n2
        FROM e WINDOW p AS (PARTITION BY doc_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      SELECT doc_id, ordinal, level, number, {ad.strip_sql("substr(bare, length(number) + 1)")} AS title, CASE level WHEN 2 THEN n1 WHEN 3 THEN coalesce(n2, n1) END AS parent_number FROM w""",
    "paragraph_segments": rf"""WITH {ad.TOC_SQL}, t AS (SELECT title, min(id) AS id FROM tree GROUP BY title),
      p AS (SELECT doc_id, 't ' || n_name AS section, unnest(l) AS raw, generate_subscripts(l, 1) AS idx FROM (SELECT doc_id, n_name, list_filter(string_split_regex(regexp_replace(text, '\n#', chr(10) || chr(10) || '#', 'g'), '\n{{2,}}'), lambda x: {ad.strip_sql("x")} <> '') AS l FROM documents JOIN nation ON doc_id % 25 = n_nationkey)),
      h AS (SELECT *, {_BARE("split_part(raw, chr(10), 1)")} AS head FROM p)
      SELECT doc_id::VARCHAR AS source, row_number() OVER (PARTITION BY doc_id ORDER BY idx)::INT AS position, t.id::VARCHAR AS section_id, substr(head, 1, 60) AS title, {ad.strip_sql(f"regexp_replace(raw, '{_WS}+', ' ', 'g')")} AS content,
        CASE WHEN regexp_matches(head, '(?i)^(定理|theorem)') THEN 'theorem' WHEN regexp_matches(head, '(?i)^(证明|proof)') THEN 'proof' WHEN regexp_matches(head, '(?i)^(例|example)') THEN 'example' WHEN regexp_matches(head, '(?i)^(定义|definition)') THEN 'definition' ELSE 'note' END AS type,
        '2024-01-01T00:00:00' AS created_at, 'm' AS model, 2 AS version FROM h LEFT JOIN t ON h.section = t.title""",
    "encoder_units": "SELECT p_partkey, 256 AS n, 1.0::DOUBLE AS length FROM part",
    "judge_rules": """WITH a AS (SELECT DISTINCT event_type AS a, event_id % 3 AS k FROM events)
      SELECT a || '-' || k AS key, CASE k WHEN 0 THEN '高关联' WHEN 1 THEN '中关联' ELSE '无关联' END AS by_rule, CASE k WHEN 0 THEN '高关联' WHEN 1 THEN '中关联' ELSE '无关联' END AS by_reply, CASE WHEN k < 2 THEN a || ' c' ELSE 'failed: no answer' END AS why FROM a""",
    "batch_files": """SELECT CASE n_nationkey % 3 WHEN 0 THEN r_name || '/' || n_name || '.md' WHEN 1 THEN n_name || '.md' ELSE substr(n_name, 2) || '.md' END AS file, n_name AS section,
      CASE WHEN n_nationkey % 3 < 2 THEN 'file:/books/' || r_name || '/' || n_name || '.md' END AS path, CASE WHEN n_nationkey % 3 < 2 THEN 'text of ' || n_name END AS text FROM nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL SELECT 'ASIA/none.md', 'x', NULL, NULL""",
    "iso_times": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at FROM events",
    "path_names": "SELECT n_nationkey, n_name || '.v1' AS stem, 'a/b.c/' || n_name || '.v1_pretty.json' AS pretty FROM nation",
    "fixed_decimals": "SELECT c_custkey, printf('%.3f', c_acctbal) AS shown FROM customer",
    "tree_levels": """WITH e AS (SELECT c_nationkey AS book_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) + 1 AS id, (1 + c_custkey * 7 % 9)::INT AS level, 'n' || c_custkey % 7 AS number, c_name AS title,
        CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'n' || c_custkey % 5 WHEN 2 THEN 'book' ELSE 'nowhere' END AS parent_number FROM customer),
      above AS (SELECT i.book_id, i.id, j.id AS j, j.level, j.number = i.parent_number AS named FROM e i JOIN e j ON i.book_id = j.book_id AND j.id < i.id AND j.level < i.level
        WHERE NOT EXISTS (SELECT 1 FROM e k WHERE k.book_id = i.book_id AND k.id > j.id AND k.id < i.id AND k.level <= j.level)),
      best AS (SELECT book_id, id, arg_max(j, level) FILTER (named) AS by_name, arg_max(j, level) AS nearest FROM above GROUP BY ALL)
      SELECT book_id, id, level, number, title, CASE WHEN parent_number IS NULL THEN 1 ELSE coalesce(by_name, CASE WHEN parent_number = 'book' THEN 1 END, nearest, 1) END AS parent_id FROM e LEFT JOIN best USING (book_id, id)
      UNION ALL SELECT DISTINCT c_nationkey, 1, 0, NULL, 'book', NULL FROM customer""",
}
