"""The driver's tables in the shapes of the knowledge base, and the same shapes in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas.functions.text import offsets, strip

#: The data's similarities are low; the product's default of 0.75 would match nothing here.
THRESHOLD = 0.30
WS_SQL = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_SQL}+|{WS_SQL}+$', '', 'g')"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment for each line of a document that isn't blank: the line is its title and content, its words in turn are aliases and
    entities. ordinal: document, then line."""
    lines = read(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).where(strip("line") != "")
    kinds = F.array(*[F.lit(k) for k in ("concept", "theorem", "proof", "example", "note")])
    words = F.split("line", " ", -1)
    return lines.select(
        (F.col("doc_id") * (1 << 20) + F.col("pos")).alias("ordinal"), "source", "doc_id", F.col("line").alias("title"), F.col("line").alias("content"),
        F.get(kinds, F.pmod("doc_id", F.lit(5)).cast("int")).alias("type"), F.filter(words, lambda w, i: i % 2 == 0).alias("aliases"), F.array_join(F.filter(words, lambda w, i: i % 2 == 1), ",").alias("entities"), F.lit("2024-01-01T00:00:00").alias("created_at"),
    )


SEGMENTS_SQL = f"""
lines AS (SELECT doc_id, source, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents)),
seg AS (
  SELECT doc_id * 1048576 + pos AS ordinal, source, doc_id, line AS title, line AS content,
    ['concept', 'theorem', 'proof', 'example', 'note'][(doc_id % 5)::INT + 1] AS type,
    list_filter(string_split(line, ' '), lambda w, i: i % 2 = 1) AS aliases, array_to_string(list_filter(string_split(line, ' '), lambda w, i: i % 2 = 0), ',') AS entities, '2024-01-01T00:00:00' AS created_at
  FROM lines WHERE {strip_sql("line")} <> ''
)"""

CONCEPTS_SQL = f"""
named AS (SELECT {strip_sql("title")} AS name, source AS file_path, content, type AS concept_type, created_at, ordinal FROM seg WHERE type IN ('concept', 'definition', 'theorem')),
con AS (
  SELECT printf('C%03d', row_number() OVER (ORDER BY ordinal)) AS concept_id, name, file_path, name AS title, content, concept_type, created_at, ordinal
  FROM (SELECT * FROM named WHERE name <> '' QUALIFY row_number() OVER (PARTITION BY name ORDER BY ordinal) = 1)
)"""

ALIASES_SQL = f"""
al AS (
  SELECT unnest(aliases) AS alias, generate_subscripts(aliases, 1) AS idx, 0 AS kind, 'alias' AS alias_type, ordinal AS block_id, source AS source_doc, created_at FROM seg WHERE type IN ('concept', 'definition', 'theorem')
  UNION ALL
  SELECT {strip_sql("e")}, idx, 1, 'entity', ordinal, source, created_at FROM (SELECT unnest(string_split(entities, ',')) AS e, generate_subscripts(string_split(entities, ','), 1) AS idx, ordinal, source, created_at FROM seg)
),
ali AS (SELECT alias, block_id, alias_type, source_doc, created_at FROM al WHERE alias <> '' QUALIFY row_number() OVER (PARTITION BY alias ORDER BY block_id, kind, idx) = 1)"""


def vector_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as a concept."""
    e = read(spark, sf_dir, "embeddings")
    code = F.format_string("V%06d", "vec_id")
    return e.select(code.alias("concept_id"), F.concat(F.lit("n"), F.col("label")).alias("name"), F.lit("").alias("file_path"), F.lit("").alias("title"), F.lit("").alias("content"), F.lit("concept").alias("concept_type"), F.lit("").alias("created_at"), "embedding")


def vector_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector, turned by one component, as a pending alias; every third is an alias, the others are entities."""
    e = read(spark, sf_dir, "embeddings")
    turned = F.concat(F.slice("embedding", 2, F.size("embedding")), F.slice("embedding", 1, 1))
    kind = F.when(F.pmod("vec_id", F.lit(3)) == 0, "alias").otherwise("entity")
    return e.select(
        F.concat(F.lit("a"), F.col("vec_id")).alias("alias"), F.col("vec_id").alias("block_id"), F.lit(None).cast("string").alias("concept_id"), kind.alias("alias_type"), F.lit("").alias("source_doc"), F.lit(0.0).alias("confidence"),
        F.lit("pending").alias("status"), F.lit(None).cast("string").alias("llm_reason"), F.lit("").alias("created_at"), turned.alias("embedding"),
    )


def edge_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vector_aliases, of which each tenth has no vector and the one after it a vector of no length."""
    e = vector_aliases(spark, sf_dir)
    k = F.pmod("block_id", F.lit(10))
    return e.withColumn("embedding", F.when(k == 2, F.transform("embedding", lambda x: F.lit(0.0).cast("float"))).when(k != 1, F.col("embedding")))


VECTORS_SQL = """
c AS (SELECT printf('V%06d', vec_id) AS concept_id, 'n' || label AS name, embedding::DOUBLE[] AS e FROM embeddings),
a AS (SELECT 'a' || vec_id AS alias, vec_id AS block_id, CASE WHEN vec_id % 3 = 0 THEN 'alias' ELSE 'entity' END AS alias_type, list_concat(embedding[2:], embedding[1:1])::DOUBLE[] AS e FROM embeddings),
best AS (
  SELECT alias, alias_type, arg_max(concept_id, s) AS best, max(s) AS similarity FROM (SELECT a.alias, a.alias_type, c.concept_id, list_cosine_similarity(a.e, c.e) AS s FROM a CROSS JOIN c) WHERE s > 0 GROUP BY ALL
),
judged AS (
  SELECT a.alias, a.alias_type, b.best, b.similarity, CASE WHEN c.name IN ('n0', 'n1', 'n2') THEN '高关联' WHEN c.name IN ('n3', 'n4') THEN '中关联' ELSE '无关联' END AS decision
  FROM a LEFT JOIN best b USING (alias) LEFT JOIN c ON c.concept_id = b.best
),
aligned AS (
  SELECT alias, alias_type,
    CASE WHEN similarity >= 0.3 AND alias_type = 'alias' THEN 'auto_mapped' WHEN similarity >= 0.3 AND decision = '高关联' THEN 'llm_confirmed' ELSE 'needs_review' END AS status,
    CASE WHEN alias_type = 'alias' OR (similarity >= 0.3 AND decision = '高关联') THEN best END AS concept_id, coalesce(similarity, 0.0) AS confidence,
    CASE WHEN similarity >= 0.3 AND alias_type <> 'alias' THEN 'LLM:' || decision || '|label' END AS said
  FROM judged
)"""


#: As aligned, with the rows of edge_aliases and whole reasons.
EDGES_SQL = f"""{VECTORS_SQL},
edge AS (
  SELECT j.alias, j.alias_type, a.block_id % 10 = 1 AS none, CASE WHEN a.block_id % 10 <> 2 THEN best END AS best, CASE WHEN a.block_id % 10 <> 2 THEN similarity END AS similarity, CASE WHEN a.block_id % 10 <> 2 THEN decision END AS decision
  FROM judged j JOIN a USING (alias)
),
edges AS (
  SELECT alias, alias_type, CASE WHEN none THEN 'unmapped' WHEN similarity >= 0.3 AND alias_type = 'alias' THEN 'auto_mapped' WHEN similarity >= 0.3 AND decision = '高关联' THEN 'llm_confirmed' ELSE 'needs_review' END AS status,
    CASE WHEN NOT none AND (alias_type = 'alias' OR (similarity >= 0.3 AND decision = '高关联')) THEN best END AS concept_id, CASE WHEN none THEN 0.0 ELSE round(coalesce(similarity, 0.0), 6) END AS confidence,
    CASE WHEN none THEN NULL WHEN similarity >= 0.3 AND alias_type = 'alias' THEN '向量匹配(阈值0.3)' WHEN similarity >= 0.3 THEN 'LLM:' || decision || '|label' WHEN alias_type = 'alias' OR best IS NOT NULL THEN printf('向量相似度不足(%.3f<0.3)', coalesce(similarity, 0.0)) ELSE '无匹配概念' END AS llm_reason
  FROM edge
)"""


def label_judge(asked: DataFrame) -> DataFrame:
    """A deterministic judge for these tables: by the concept's label."""
    decision = F.when(F.col("name").isin("n0", "n1", "n2"), "高关联").when(F.col("name").isin("n3", "n4"), "中关联").otherwise("无关联")
    return asked.withColumns({"decision": decision, "reason": F.lit("label")})


def toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations and customers as the chapters, sections and subsections of a book for each region. A customer in debt
    names a parent that doesn't exist."""
    r, n, c = (read(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    base = lambda level, key, number, parent, book: [F.col(book).alias("book_id"), F.lit(level).alias("level"), key.alias("key"), number.alias("number"), F.concat(F.lit("t "), number).alias("title"), parent.alias("parent_number")]
    n = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    c = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    none = F.lit(None).cast("string")
    rows = r.select(*base(1, F.struct(F.lit(-1).alias("n"), F.lit(-1).cast("long").alias("c")), F.col("r_name"), none, "r_regionkey"))
    rows = rows.unionByName(n.select(*base(2, F.struct(F.col("n_nationkey").alias("n"), F.lit(-1).cast("long").alias("c")), F.col("n_name"), F.col("r_name"), "r_regionkey")))
    parent = F.when(F.col("c_acctbal") < 0, "nowhere").otherwise(F.col("n_name"))
    rows = rows.unionByName(c.select(*base(3, F.struct(F.col("n_nationkey").alias("n"), F.col("c_custkey").alias("c")), F.col("c_name"), parent, "r_regionkey")))
    return rows.withColumn("ordinal", F.row_number().over(W.partitionBy("book_id").orderBy("key")).cast("long")).drop("key")


TOC_SQL = """
n AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
rows_ AS (
  SELECT r_regionkey AS book_id, 1 AS level, -1 AS kn, -1 AS kc, r_name AS number, NULL AS parent_number FROM region
  UNION ALL SELECT r_regionkey, 2, n_nationkey, -1, n_name, r_name FROM n
  UNION ALL SELECT r_regionkey, 3, n_nationkey, c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'nowhere' ELSE n_name END FROM customer JOIN n ON c_nationkey = n_nationkey
),
e AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY kn, kc) + 1 AS id FROM rows_),
w AS (
  SELECT *, last_value(CASE WHEN level = 1 THEN {'id': id, 'number': number} END IGNORE NULLS) OVER b AS s1, last_value(CASE WHEN level = 2 THEN {'id': id, 'number': number} END IGNORE NULLS) OVER b AS s2
  FROM e WINDOW b AS (PARTITION BY book_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
tree AS (
  SELECT book_id, id, level, number, 't ' || number AS title,
    CASE WHEN parent_number IS NULL THEN 1
      WHEN level = 3 THEN CASE WHEN s2.id > s1.id AND s2.number = parent_number THEN s2.id WHEN s1.number = parent_number THEN s1.id WHEN s2.id > s1.id THEN s2.id ELSE coalesce(s1.id, 1) END
      ELSE coalesce(s1.id, 1) END AS parent_id FROM w
  UNION ALL SELECT r_regionkey, 1, 0, NULL, 'book', NULL FROM region
)"""


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation as a markdown text of two headings and its words."""
    c = read(spark, sf_dir, "conversations")
    head = F.concat(F.lit("# conv "), F.col("conv_id"), F.lit("\n## "), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))
    return c.select(F.concat_ws("-", "conv_id", "turn").alias("doc_id"), head.alias("text"))


MARKDOWN_SQL = "md AS (SELECT concat_ws('-', conv_id, turn) AS doc_id, '# conv ' || conv_id || chr(10) || '## ' || coalesce(role, '') || chr(10) || coalesce(text, '') AS text FROM conversations)"
MD_LINES_SQL = f"""{MARKDOWN_SQL},
ml AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM md))"""


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of 6 to 8 letters of the documents, and all phrases of a word of 4 and one of 5 letters with a space between them; what an
    annotation shows of them is made from the alias."""
    words = F.filter(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)), lambda w: F.char_length(w).between(6, 8))
    phrases = F.regexp_extract_all("text", F.lit(r"(?<!\p{L})\p{L}{4} \p{L}{5}(?!\p{L})"), F.lit(0))
    words = read(spark, sf_dir, "documents").select(F.explode(F.concat(words, phrases)).alias("alias")).distinct()
    n = F.char_length("alias")
    kind = F.get(F.array(F.lit("concept"), F.lit("alias"), F.lit("entity")), n % 3)
    return words.select("alias", F.concat(F.lit("D"), F.md5(F.col("alias").cast("binary"))).alias("concept_id"), F.when(n % 2 == 0, F.col("alias")).otherwise(F.concat(F.lit("c "), F.col("alias"))).alias("concept_name"), kind.alias("alias_type"), F.lit("auto_mapped").alias("status"), (n / 10).alias("confidence"))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with code and formulas: of each four lines the second and the fourth are one."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.when(i % 4 == 1, F.concat(F.lit("`"), x, F.lit("`"))).when(i % 4 == 3, F.concat(F.lit("$$"), x, F.lit("$$"))).otherwise(x))
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))


MARKED_SQL = "mk AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: CASE i % 4 WHEN 2 THEN '`' || x || '`' WHEN 0 THEN '$$' || x || '$$' ELSE x END), chr(10)) AS text FROM documents)"


def tokens_sql(name: str, texts: str) -> str:
    """The runs of letters of texts, name (doc_id, piece: what stands before the run, run, before: the last run, idx)."""
    return rf"""
{name}_runs AS (
  SELECT doc_id, unnest(pieces[1:len(runs)]) AS piece, unnest(runs) AS run, generate_subscripts(runs, 1) AS idx
  FROM (SELECT doc_id, string_split_regex(text, '\p{{L}}+') AS pieces, regexp_extract_all(text, '\p{{L}}+') AS runs FROM {texts})
),
{name} AS (SELECT *, lag(run) OVER (PARTITION BY doc_id ORDER BY idx) AS before FROM {name}_runs)"""


DICTIONARY_SQL = f"""{tokens_sql("dtok", "documents")},
dict AS (SELECT DISTINCT run AS alias FROM dtok WHERE length(run) BETWEEN 6 AND 8 UNION SELECT before || ' ' || run FROM dtok WHERE piece = ' ' AND length(before) = 4 AND length(run) = 5)"""


def matches_sql(texts: str) -> str:
    """All occurrences of the dictionary's aliases, m (doc_id, s, e, alias): a word lies in one run of letters, a phrase in two with a space
    between them."""
    return rf"""{tokens_sql("tok", texts)},{DICTIONARY_SQL},
pos AS MATERIALIZED (SELECT doc_id, idx, run, before, piece, sum(length(piece) + length(run)) OVER (PARTITION BY doc_id ORDER BY idx) - length(run) AS start FROM tok),
subs AS (SELECT run, n, unnest(range(1, length(run) - n + 2)) AS i FROM (SELECT DISTINCT run FROM tok), (VALUES (6), (7), (8)) v(n) WHERE length(run) >= n),
inside AS (SELECT run, alias, i - 1 AS off FROM subs JOIN dict ON substr(run, i, n) = alias),
m AS MATERIALIZED (
  SELECT doc_id, (start + off)::INT AS s, (start + off + length(alias))::INT AS e, alias FROM pos JOIN inside USING (run)
  UNION ALL SELECT doc_id, (start - 5)::INT, (start + 5)::INT, alias FROM pos JOIN dict ON alias = right(before, 4) || ' ' || left(run, 5) WHERE piece = ' ' AND length(before) >= 4 AND length(run) >= 5)"""


_PATTERNS = ("(?s)```.*?```", r"(?s)\$\$.*?\$\$", "`[^`]+`", r"\$[^$\n]+?\$", r"!\[.*?\]\(.*?\)")
SKIPS_SQL = "hit AS (" + " UNION ALL ".join(f"SELECT doc_id, regexp_extract_all(text, '{p}') AS h, string_split_regex(text, '{p}') AS g FROM mk" for p in _PATTERNS) + r"""),
reg0 AS (SELECT doc_id, row_number() OVER () AS k, h, g FROM hit),
reg1 AS (SELECT doc_id, k, unnest(h) AS h, unnest(g[1:len(h)]) AS g, generate_subscripts(h, 1) AS i FROM reg0),
reg AS (SELECT doc_id, (sum(length(g) + length(h)) OVER (PARTITION BY k ORDER BY i) - length(h))::INT AS s, (sum(length(g) + length(h)) OVER (PARTITION BY k ORDER BY i))::INT AS e FROM reg1)"""
#: The annotation: matches with neither end in a skipped region, of overlapping ones (all in one island without a gap) the longest, then the first.
SPANS_SQL = f"""{MARKED_SQL},{matches_sql("mk")},
{SKIPS_SQL},
bad AS (SELECT DISTINCT m.doc_id, m.s, m.e FROM m JOIN reg r ON r.doc_id = m.doc_id AND ((r.s <= m.s AND m.s < r.e) OR (r.s < m.e AND m.e <= r.e))),
good AS (SELECT *, CASE WHEN s >= max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM m ANTI JOIN bad USING (doc_id, s, e)),
isle AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS idx FROM good),
chosen AS (
  SELECT doc_id, unnest(list_reduce(list([{{'s': s, 'e': e, 'alias': alias}}] ORDER BY e - s DESC, s), lambda acc, y: CASE WHEN len(list_filter(acc, lambda k: k.s < y[1].e AND y[1].s < k.e)) = 0 THEN list_concat(acc, y) ELSE acc END)) AS c
  FROM isle GROUP BY doc_id, idx
),
span AS (
  SELECT doc_id, c.s AS s, c.e AS e, c.alias AS alias, 'D' || md5(c.alias) AS concept_id, CASE WHEN length(c.alias) % 2 = 0 THEN c.alias ELSE 'c ' || c.alias END AS concept_name,
    ['concept', 'alias', 'entity'][length(c.alias) % 3 + 1] AS alias_type, ['概念本身', '别名', '实体词'][length(c.alias) % 3 + 1] AS label, length(c.alias) / 10.0::DOUBLE AS confidence FROM chosen
)"""


CUTS = ("[^.!?]+", r"[^\n]+")


def cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines and the sentences of the marked documents as spans: a sentence may run over lines."""
    found = F.concat(*[offsets(F.col("text"), p) for p in CUTS])
    return marked(spark, sf_dir).select("doc_id", F.explode(found).alias("m")).select("doc_id", "m.start", "m.end")


def offsets_sql(name: str, texts: str, patterns: tuple[str, ...]) -> str:
    """name (doc_id, s, e): all matches of the patterns in texts."""
    hits = " UNION ALL ".join(f"SELECT doc_id, regexp_extract_all(text, '{p}') AS h, string_split_regex(text, '{p}') AS g FROM {texts}" for p in patterns)
    return rf"""{name}_hit AS (SELECT *, row_number() OVER () AS k FROM ({hits})),
{name}_each AS (SELECT doc_id, k, unnest(h) AS h, unnest(g[1:len(h)]) AS g, generate_subscripts(h, 1) AS i FROM {name}_hit),
{name} AS (SELECT doc_id, (sum(length(g) + length(h)) OVER (PARTITION BY k ORDER BY i) - length(h))::INT AS s, (sum(length(g) + length(h)) OVER (PARTITION BY k ORDER BY i))::INT AS e FROM {name}_each)"""


CUTS_SQL = f"""{MARKED_SQL},
{SKIPS_SQL},
{offsets_sql("cut", "mk", CUTS)},
cut1 AS (SELECT DISTINCT doc_id, s, e FROM cut),
bad AS (SELECT DISTINCT m.doc_id, m.s, m.e FROM cut1 m JOIN reg r ON r.doc_id = m.doc_id AND ((r.s <= m.s AND m.s < r.e) OR (r.s < m.e AND m.e <= r.e))),
good AS (SELECT *, CASE WHEN s >= max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM cut1 ANTI JOIN bad USING (doc_id, s, e)),
isle AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS idx FROM good),
chosen AS (
  SELECT doc_id, unnest(list_reduce(list([{{'s': s, 'e': e}}] ORDER BY e - s DESC, s), lambda acc, y: CASE WHEN len(list_filter(acc, lambda k: k.s < y[1].e AND y[1].s < k.e)) = 0 THEN list_concat(acc, y) ELSE acc END)) AS c
  FROM isle GROUP BY doc_id, idx
)"""
