"""The registered queries of the knowledge base, and DuckDB SQL with the same results where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas import schemas
from lexatlas.functions import text as tx
from lexatlas.operators import align, annotate, concepts, hierarchy, search, sections, spans
from lexatlas.plans import adapters as ad
from lexatlas.plans import files
from lexatlas.scratch import scratch_path, staged
from lexatlas.sources import buckets
from lexatlas.streaming import incremental

RULES = files.RULES
Query = Callable[[SparkSession, str], DataFrame]


def _aligned(s: SparkSession, d: str) -> DataFrame:
    return align.align(ad.vector_aliases(s, d), ad.vector_concepts(s, d), ad.label_judge, threshold=ad.THRESHOLD)


def vec_topk(s: SparkSession, d: str) -> DataFrame:
    e = ad.read(s, d, "embeddings")
    query = e.orderBy("vec_id").first()  # the query is one given vector
    found = search.search_vectors(e, list(query["embedding"]) if query else [0.0], 5, key="vec_id")
    return found.select("vec_id", F.round("similarity", 6).alias("similarity"))


def vec_topk_batch(s: SparkSession, d: str) -> DataFrame:
    e = ad.read(s, d, "embeddings")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return search.search_many(first, e, 5, query_key="label", key="vec_id").withColumn("similarity", F.round("similarity", 6))


def vec_best_match(s: SparkSession, d: str) -> DataFrame:
    return align.best_match(ad.vector_aliases(s, d), ad.vector_concepts(s, d)).withColumn("similarity", F.round("similarity", 6))


def align_status(s: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("llm_reason").startswith("LLM:"), F.col("llm_reason"))
    return _aligned(s, d).select("alias", "alias_type", "status", "concept_id", F.round("confidence", 6).alias("confidence"), said.alias("said"))


def align_status_counts(s: SparkSession, d: str) -> DataFrame:
    return align.status_counts(_aligned(s, d))


def align_outcomes(s: SparkSession, d: str) -> DataFrame:
    return align.outcome_counts(_aligned(s, d))


def align_rerun_reset(s: SparkSession, d: str) -> DataFrame:
    return align.reset_entities(_aligned(s, d)).select("alias", "status", "concept_id", F.round("confidence", 6).alias("confidence"))


def alias_left_join(s: SparkSession, d: str) -> DataFrame:
    return search.list_aliases(_aligned(s, d), ad.vector_concepts(s, d)).withColumn("confidence", F.round("confidence", 6))


def alias_needs_review(s: SparkSession, d: str) -> DataFrame:
    return search.needs_review(_aligned(s, d), ad.vector_concepts(s, d)).drop("llm_reason").withColumn("confidence", F.round("confidence", 6))


def alias_search(s: SparkSession, d: str) -> DataFrame:
    return search.search_alias(_aligned(s, d), ad.vector_concepts(s, d), "A1").withColumn("confidence", F.round("confidence", 6))


def concept_list(s: SparkSession, d: str) -> DataFrame:
    return search.list_concepts(ad.vector_concepts(s, d))


def manual_assign(s: SparkSession, d: str) -> DataFrame:
    a, c = ad.vector_aliases(s, d), ad.vector_concepts(s, d)
    done, _ = search.manual_assign(a, c, "a0", "V000001")
    return done.select("alias", "concept_id", "status", "llm_reason")


def constraint_report(s: SparkSession, d: str) -> DataFrame:
    return schemas.constraint_report(ad.vector_concepts(s, d), _aligned(s, d))


def constraint_violations(s: SparkSession, d: str) -> DataFrame:
    """The report on a base that breaks each rule: suppliers as concepts, customers as aliases."""
    sup, cus = ad.read(s, d, "supplier"), ad.read(s, d, "customer")
    known = sup.select(F.concat(F.lit("C"), F.col("s_suppkey") % 90).alias("concept_id"), F.when(F.col("s_nationkey") % 7 != 0, F.col("s_name")).alias("name"))
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "alias").when(F.col("c_mktsegment") == "MACHINERY", "entity").when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment"))
    status = F.when(F.col("c_nationkey") % 6 < 5, F.get(F.array(*map(F.lit, schemas.STATUSES)), (F.col("c_nationkey") % 5).cast("int"))).otherwise("lost")
    concept = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("C"), F.col("c_custkey") % 120))
    return schemas.constraint_report(known, cus.select(F.concat(F.lit("a"), F.col("c_custkey") % 140).alias("alias"), kind.alias("alias_type"), status.alias("status"), concept.alias("concept_id")))


def concept_extract(s: SparkSession, d: str) -> DataFrame:
    return concepts.extract_concepts(ad.segments(s, d)).drop("ordinal")


def alias_extract(s: SparkSession, d: str) -> DataFrame:
    return concepts.extract_aliases(ad.segments(s, d))


def _increments(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    # laid down: the second increment reads the first base several times, as it would read stored tables
    seg = ad.segments(s, d)
    first = [staged(t, "increment") for t in concepts.build_base(seg.where("type = 'concept'"))]
    return concepts.build_base(seg, *first)


def incremental_concepts(s: SparkSession, d: str) -> DataFrame:
    return _increments(s, d)[0].select("concept_id", "name", "concept_type")


def incremental_aliases(s: SparkSession, d: str) -> DataFrame:
    return _increments(s, d)[1].select("alias", "alias_type", "block_id", "status")


def bucketed_aliases(s: SparkSession, d: str) -> DataFrame:
    """The aliases of both increments, kept in buckets: the second writes only those that its new rows fall in."""
    seg, folder = ad.segments(s, d), scratch_path(s, "base")
    incremental.increment_buckets(s, seg.where("type = 'concept'"), folder)
    incremental.increment_buckets(s, seg, folder)
    return buckets.read_buckets(s, f"{folder}/aliases", schemas.ALIASES).select("alias", "alias_type", "block_id", "status")


def upsert_precedence(s: SparkSession, d: str) -> DataFrame:
    return concepts.build_base(ad.segments(s, d))[1].select("alias", "alias_type", "status", "concept_id", "confidence")


def segment_store(s: SparkSession, d: str) -> DataFrame:
    return concepts.knowledge_segments(ad.segments(s, d)).select("id", "source", "title", "type")


def segment_view(s: SparkSession, d: str) -> DataFrame:
    stored = concepts.knowledge_segments(ad.segments(s, d).withColumn("needs_review", F.col("type") == "note"), lambda text: F.array(F.length(text).cast("float"), F.lit(1.0).cast("float")))
    return concepts.text_view(stored).select("id", "aliases", "needs_review", F.col("embedding_bytes").cast("long").alias("embedding_bytes"))


def alias_display(s: SparkSession, d: str) -> DataFrame:
    """Icon and concept of each alias as displayed; numbers are left to reports."""
    shown = search.displayed(search.list_aliases(_aligned(s, d), ad.vector_concepts(s, d)))
    return shown.select("alias", F.substring_index("line", " conf=", 1).alias("line"))


def dictionary_load(s: SparkSession, d: str) -> DataFrame:
    return annotate.load_dictionary(_aligned(s, d), ad.vector_concepts(s, d)).select("alias", "concept_id", "concept_name", "alias_type", "status")


def type_counts(s: SparkSession, d: str) -> DataFrame:
    return concepts.type_counts(ad.segments(s, d))


def alias_type_counts(s: SparkSession, d: str) -> DataFrame:
    return concepts.extract_aliases(ad.segments(s, d)).groupBy("alias_type").agg(F.count(F.lit(1)).alias("n"))


def embed_text(s: SparkSession, d: str) -> DataFrame:
    return ad.segments(s, d).select("ordinal", tx.embedding_text("title", "content").alias("embed_text"))


def preview_200(s: SparkSession, d: str) -> DataFrame:
    return ad.read(s, d, "documents").select("doc_id", tx.preview("text").alias("preview"))


def content_clean(s: SparkSession, d: str) -> DataFrame:
    return ad.read(s, d, "documents").select("doc_id", tx.collapse("text").alias("content"))


def file_names(s: SparkSession, d: str) -> DataFrame:
    return ad.read(s, d, "pages").select("page_id", tx.sanitize_filename("url").alias("file_name"))


def json_repair(s: SparkSession, d: str) -> DataFrame:
    """Each text in a fenced JSON reply, its words joined by lone backslashes that JSON doesn't know."""
    body = F.regexp_replace(F.coalesce("text", F.lit("")), '["\\\\\\x00-\\x20]+', r"\\q")
    broken = F.concat(F.lit('```json\n{"k": "\\lim '), body, F.lit('"}\n```'))
    return ad.read(s, d, "documents").select("doc_id", F.get_json_object(tx.repair_json_backslashes(tx.strip_fences(broken)), "$.k").alias("k"))


def toc_parent(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.chapter_tree(ad.toc(s, d), "book").select("book_id", "id", "level", "number", "title", "parent_id")


def section_lookup(s: SparkSession, d: str) -> DataFrame:
    tree = hierarchy.chapter_tree(ad.toc(s, d), "book")
    names = ad.read(s, d, "nation").select(F.concat(F.lit("t "), F.col("n_name")).alias("section")).unionByName(ad.read(s, d, "customer").select(F.col("c_name").alias("section"))).unionByName(ad.read(s, d, "supplier").select(F.col("s_name").alias("section")))
    return hierarchy.section_lookup(names, tree)


def heading_normalise(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.normalise_headings(ad.markdown(s, d), RULES)


def split_h1(s: SparkSession, d: str) -> DataFrame:
    return sections.split_h1(ad.markdown(s, d)).drop("ordinal")


def split_h2(s: SparkSession, d: str) -> DataFrame:
    return sections.split_h2(ad.markdown(s, d)).drop("ordinal")


def skip_ranges(s: SparkSession, d: str) -> DataFrame:
    return ad.read(s, d, "documents").select("doc_id", F.size(tx.skip_ranges("text")).cast("long").alias("n_skips"))


def dict_match_counts(s: SparkSession, d: str) -> DataFrame:
    return annotate.match_counts(ad.read(s, d, "documents"), ad.dictionary(s, d).select("alias"))


def skip_offsets(s: SparkSession, d: str) -> DataFrame:
    return ad.marked(s, d).select("doc_id", F.explode(tx.skip_ranges("text")).alias("r")).select("doc_id", F.col("r.start").alias("start"), F.col("r.end").alias("end"))


def span_resolve(s: SparkSession, d: str) -> DataFrame:
    total = lambda c: F.aggregate("spans", F.lit(0).cast("long"), lambda a, m: a + m[c])
    return annotate.annotate(ad.marked(s, d), ad.dictionary(s, d), fields=("start", "end")).select("doc_id", F.size("spans").cast("long").alias("n_spans"), total("start").alias("starts"), total("end").alias("ends"))


def annotation_table(s: SparkSession, d: str) -> DataFrame:
    once = annotate.ids_once(ad.read(s, d, "documents"), "doc_id")
    return annotate.annotation_rows(annotate.annotate(ad.marked(s, d), ad.dictionary(s, d)), once=once)


def annotated_inline(s: SparkSession, d: str) -> DataFrame:
    spans = annotate.annotate(ad.marked(s, d), ad.dictionary(s, d))
    return annotate.rendered(spans, inline_links=True).select("doc_id", "annotated")


def span_ranges(s: SparkSession, d: str) -> DataFrame:
    """Overlapping lines and sentences outside code and formulas, as rows that may be dealt anywhere."""
    regions = skip_offsets(s, d)
    return spans.resolve(ad.cuts(s, d), regions)


def _edges(s: SparkSession, d: str) -> DataFrame:
    return align.align(ad.edge_aliases(s, d), ad.vector_concepts(s, d), ad.label_judge, threshold=ad.THRESHOLD)


def _decided(aligned: DataFrame) -> DataFrame:
    return aligned.select("alias", "alias_type", "status", "concept_id", F.round("confidence", 6).alias("confidence"), "llm_reason")


def align_edges(s: SparkSession, d: str) -> DataFrame:
    """All rows of the decision table: no vector, no match, below and above the threshold."""
    return _decided(_edges(s, d))


def align_rerun(s: SparkSession, d: str) -> DataFrame:
    """Entities reset and aligned again."""
    again = align.align(_edges(s, d), ad.vector_concepts(s, d), ad.label_judge, threshold=ad.THRESHOLD, rerun=True)
    return _decided(again)


def judge_prompt(s: SparkSession, d: str) -> DataFrame:
    """What a judge sees of a concept's content: its first 300 code points."""
    known = ad.vector_concepts(s, d).withColumn("content", F.repeat("concept_id", 60))
    done = align.align(ad.vector_aliases(s, d), known, lambda asked: ad.label_judge(asked).withColumn("reason", F.col("content")), threshold=ad.THRESHOLD)
    return done.where(F.col("llm_reason").startswith("LLM:")).select("alias", "llm_reason")


def alias_lines(s: SparkSession, d: str) -> DataFrame:
    """Whole display lines, confidence included."""
    return search.displayed(search.list_aliases(_aligned(s, d), ad.vector_concepts(s, d))).select("alias", "line")


def default_lists(s: SparkSession, d: str) -> DataFrame:
    """Aliases and entities of segments of which some have no lists at all."""
    seg = ad.segments(s, d)
    seg = seg.withColumns({"aliases": F.when(F.col("ordinal") % 2 == 0, F.col("aliases")), "entities": F.when(F.col("ordinal") % 3 == 0, F.col("entities")), "source": F.when(F.col("doc_id") % 2 == 0, F.col("source"))})
    return concepts.extract_aliases(seg)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        vec_topk, vec_topk_batch, vec_best_match, align_status, align_status_counts, align_outcomes, align_rerun_reset, alias_left_join, alias_needs_review, alias_search, concept_list, manual_assign, constraint_report, constraint_violations,
        concept_extract, alias_extract, incremental_concepts, incremental_aliases, bucketed_aliases, upsert_precedence, segment_store, segment_view, alias_display, dictionary_load, type_counts, alias_type_counts, embed_text, preview_200, content_clean, file_names, json_repair,
        toc_parent, section_lookup, heading_normalise, split_h1, split_h2, skip_ranges, skip_offsets, dict_match_counts, span_resolve, annotation_table, annotated_inline, span_ranges, align_edges, align_rerun, judge_prompt, alias_lines,
        default_lists,
    )
}

_WITH = f"WITH {ad.SEGMENTS_SQL},{ad.CONCEPTS_SQL},{ad.ALIASES_SQL}"
_VEC = f"WITH {ad.VECTORS_SQL}"
_TOC = f"WITH {ad.TOC_SQL}"
#: Increment: names of the first build keep their codes, later ones continue.
_NAMES = f"""{_WITH},
first AS (SELECT name, row_number() OVER (ORDER BY ordinal) AS k, concept_type FROM (SELECT * FROM named WHERE name <> '' AND concept_type = 'concept' QUALIFY row_number() OVER (PARTITION BY name ORDER BY ordinal) = 1)),
later AS (SELECT name, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY ordinal) AS k, concept_type FROM (SELECT * FROM named WHERE name <> '' AND name NOT IN (SELECT name FROM first) QUALIFY row_number() OVER (PARTITION BY name ORDER BY ordinal) = 1)),
base AS (SELECT printf('C%03d', k) AS concept_id, name, concept_type FROM (SELECT * FROM first UNION ALL SELECT * FROM later))"""
_WS = ad.WS_SQL
_BARE = rf"regexp_replace(regexp_replace(regexp_replace({ad.strip_sql('line')}, '^#+{_WS}*', ''), '^\*+{_WS}*', ''), '{_WS}*\*+$', '')"

ORACLES: dict[str, str] = {
    "vec_topk": """WITH q AS (SELECT embedding::DOUBLE[] AS e FROM embeddings ORDER BY vec_id LIMIT 1)
      SELECT vec_id, round(s, 6) AS similarity FROM (SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[], q.e) AS s FROM embeddings, q) ORDER BY s DESC, vec_id LIMIT 5""",
    "vec_topk_batch": """WITH q AS (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS e FROM embeddings GROUP BY label),
      s AS (SELECT q.label, v.vec_id, list_cosine_similarity(v.embedding::DOUBLE[], q.e) AS s FROM embeddings v, q)
      SELECT label, vec_id, round(s, 6) AS similarity, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id)::INT AS rank FROM s QUALIFY rank <= 5""",
    "vec_best_match": f"{_VEC} SELECT alias, best, round(similarity, 6) AS similarity FROM best",
    "align_status": f"{_VEC} SELECT alias, alias_type, status, concept_id, round(confidence, 6) AS confidence, said FROM aligned",
    "align_status_counts": f"{_VEC} SELECT status, count(*) AS n FROM aligned GROUP BY status",
    "align_outcomes": f"""{_VEC} SELECT count(*) FILTER (status = 'auto_mapped') AS auto_mapped, count(*) FILTER (status = 'llm_confirmed') AS llm_confirmed, count(*) FILTER (said LIKE 'LLM:无关联%') AS llm_rejected,
      count(*) FILTER (status = 'needs_review' AND coalesce(said, '') NOT LIKE 'LLM:无关联%') AS needs_review, count(*) FILTER (status = 'unmapped') AS unmapped FROM aligned""",
    "align_rerun_reset": f"{_VEC} SELECT alias, CASE WHEN alias_type = 'entity' THEN 'pending' ELSE status END AS status, CASE WHEN alias_type <> 'entity' THEN concept_id END AS concept_id, CASE WHEN alias_type = 'entity' THEN 0.0 ELSE round(confidence, 6) END AS confidence FROM aligned",
    "alias_left_join": f"{_VEC} SELECT alias, alias_type, x.concept_id, c.name AS concept_name, round(confidence, 6) AS confidence, status FROM aligned x LEFT JOIN c USING (concept_id)",
    "alias_needs_review": f"{_VEC} SELECT alias, alias_type, x.concept_id, c.name AS concept_name, round(confidence, 6) AS confidence FROM aligned x LEFT JOIN c USING (concept_id) WHERE status = 'needs_review'",
    "alias_search": f"{_VEC} SELECT alias, alias_type, x.concept_id, c.name AS concept_name, round(confidence, 6) AS confidence, status FROM aligned x LEFT JOIN c USING (concept_id) WHERE lower(alias) LIKE '%a1%'",
    "concept_list": f"{_VEC} SELECT concept_id, name, 'concept' AS concept_type, '' AS file_path FROM c",
    "manual_assign": f"{_VEC} SELECT alias, CASE WHEN alias = 'a0' THEN 'V000001' END AS concept_id, CASE WHEN alias = 'a0' THEN 'llm_confirmed' ELSE 'pending' END AS status, CASE WHEN alias = 'a0' THEN '人工指定' END AS llm_reason FROM a",
    "constraint_report": f"""{_VEC} SELECT 'concepts.concept_id unique' AS rule, (SELECT count(*) FROM (SELECT 1 FROM c GROUP BY concept_id HAVING count(*) > 1)) AS violations
      UNION ALL SELECT 'concepts.name not null', (SELECT count(*) FROM c WHERE name IS NULL) UNION ALL SELECT 'aliases.alias unique', (SELECT count(*) FROM (SELECT 1 FROM aligned GROUP BY alias HAVING count(*) > 1))
      UNION ALL SELECT 'aliases.alias_type known', (SELECT count(*) FROM aligned WHERE alias_type NOT IN ('alias', 'entity', 'concept'))
      UNION ALL SELECT 'aliases.status known', (SELECT count(*) FROM aligned WHERE status NOT IN ('pending', 'auto_mapped', 'llm_confirmed', 'needs_review', 'unmapped'))
      UNION ALL SELECT 'aliases.concept_id refers to a concept', (SELECT count(*) FROM aligned WHERE concept_id NOT IN (SELECT concept_id FROM c))""",
    "constraint_violations": """WITH c AS (SELECT 'C' || s_suppkey % 90 AS concept_id, CASE WHEN s_nationkey % 7 <> 0 THEN s_name END AS name FROM supplier),
      a AS (SELECT 'a' || c_custkey % 140 AS alias, c_mktsegment AS segment, c_nationkey AS n, CASE WHEN c_acctbal >= 0 THEN 'C' || c_custkey % 120 END AS concept_id FROM customer)
      SELECT 'concepts.concept_id unique' AS rule, count(*) AS violations FROM (SELECT concept_id FROM c GROUP BY concept_id HAVING count(*) > 1)
      UNION ALL SELECT 'concepts.name not null', count(*) FROM c WHERE name IS NULL
      UNION ALL SELECT 'aliases.alias unique', count(*) FROM (SELECT alias FROM a GROUP BY alias HAVING count(*) > 1)
      UNION ALL SELECT 'aliases.alias_type known', count(*) FROM a WHERE segment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')
      UNION ALL SELECT 'aliases.status known', count(*) FROM a WHERE n % 6 = 5
      UNION ALL SELECT 'aliases.concept_id refers to a concept', count(*) FROM a WHERE concept_id IS NOT NULL AND concept_id NOT IN (SELECT concept_id FROM c)""",
    "concept_extract": f"{_WITH} SELECT concept_id, name, file_path, title, content, concept_type, created_at FROM con",
    "alias_extract": f"{_WITH} SELECT * FROM ali",
    "incremental_concepts": f"{_NAMES} SELECT * FROM base",
    "incremental_aliases": f"""{_NAMES},
      one AS (SELECT alias, alias_type, block_id FROM al WHERE alias <> '' AND block_id IN (SELECT ordinal FROM seg WHERE type = 'concept') QUALIFY row_number() OVER (PARTITION BY alias ORDER BY block_id, kind, idx) = 1),
      built AS (SELECT alias, alias_type, block_id, 'pending' AS status FROM one UNION ALL SELECT name, 'concept', NULL, 'auto_mapped' FROM first WHERE name NOT IN (SELECT alias FROM one)),
      two AS (SELECT alias, alias_type, block_id FROM ali WHERE alias NOT IN (SELECT alias FROM built))
      SELECT * FROM built UNION ALL SELECT alias, alias_type, block_id, 'pending' FROM two
      UNION ALL SELECT name, 'concept', NULL, 'auto_mapped' FROM later WHERE name NOT IN (SELECT alias FROM built) AND name NOT IN (SELECT alias FROM two)""",
    "upsert_precedence": f"""{_WITH} SELECT alias, alias_type, 'pending' AS status, NULL::VARCHAR AS concept_id, 0.0::DOUBLE AS confidence FROM ali
      UNION ALL SELECT name, 'concept', 'auto_mapped', concept_id, 1.0 FROM con WHERE name NOT IN (SELECT alias FROM ali)""",
    "segment_store": f"{_WITH} SELECT row_number() OVER (ORDER BY ordinal) AS id, source, title, type FROM seg",
    "segment_view": f"{_WITH} SELECT row_number() OVER (ORDER BY ordinal) AS id, to_json(aliases)::VARCHAR AS aliases, (type = 'note')::INT AS needs_review, 8::BIGINT AS embedding_bytes FROM seg",
    "alias_display": f"""{_VEC} SELECT alias, CASE status WHEN 'auto_mapped' THEN '✓' WHEN 'llm_confirmed' THEN '✓' ELSE '?' END || ' ''' || alias || ''' (' || alias_type || ') ' || CASE WHEN x.concept_id IS NULL THEN '→ (无匹配)' ELSE '→ [' || x.concept_id || '] ' || c.name END || ' [' || status || ']' AS line FROM aligned x LEFT JOIN c USING (concept_id)""",
    "dictionary_load": f"{_VEC} SELECT alias, concept_id, c.name AS concept_name, alias_type, status FROM aligned JOIN c USING (concept_id) WHERE status IN ('auto_mapped', 'llm_confirmed')",
    "type_counts": f"{_WITH} SELECT type, count(*) AS n, min(ordinal) AS first_ordinal FROM seg GROUP BY type",
    "alias_type_counts": f"{_WITH} SELECT alias_type, count(*) AS n FROM ali GROUP BY alias_type",
    "embed_text": f"{_WITH} SELECT ordinal, title || '。' || content AS embed_text FROM seg",
    "preview_200": "SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview FROM documents",
    "content_clean": f"SELECT doc_id, {ad.strip_sql(f"regexp_replace(text, '{_WS}+', ' ', 'g')")} AS content FROM documents",
    "file_names": r"""SELECT page_id, regexp_replace(regexp_replace(url, '[<>:"/\\|?*]', '_', 'g'), '^[. ]+|[. ]+$', '', 'g') AS file_name FROM pages""",
    "json_repair": r"""SELECT doc_id, '\lim ' || regexp_replace(coalesce(text, ''), '["\\\x00-\x20]+', '\\q', 'g') AS k FROM documents""",
    "toc_parent": f"{_TOC} SELECT * FROM tree",
    "section_lookup": f"""{_TOC}, s AS (SELECT 't ' || n_name AS section FROM nation UNION ALL SELECT c_name FROM customer UNION ALL SELECT s_name FROM supplier),
      t AS (SELECT title, min(id) AS id FROM tree GROUP BY title), u AS (SELECT number, min(id) AS id FROM tree WHERE number IS NOT NULL GROUP BY number)
      SELECT section, coalesce(t.id, u.id)::VARCHAR AS section_id FROM s LEFT JOIN t ON section = t.title LEFT JOIN u ON section = u.number""",
    "heading_normalise": rf"""WITH {ad.MD_LINES_SQL}, b AS (SELECT *, {_BARE} AS bare, regexp_matches(line, '^{_WS}*#') AS is_head FROM ml),
      n AS (SELECT doc_id, pos, CASE WHEN NOT is_head THEN line WHEN regexp_matches(bare, '^(conv)') THEN '# ' || bare WHEN regexp_matches(bare, '^(user)') THEN '## ' || bare WHEN regexp_matches(bare, '^(assistant|system)') THEN '### ' || bare ELSE bare END AS line FROM b)
      SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM n GROUP BY doc_id""",
    "split_h1": rf"""WITH {ad.MD_LINES_SQL}, g AS (SELECT *, count(*) FILTER (regexp_matches(line, '^#{_WS}')) OVER (PARTITION BY doc_id ORDER BY pos) AS piece FROM ml),
      p AS (SELECT doc_id, piece, {ad.strip_sql("string_agg(line, chr(10) ORDER BY pos)")} AS body FROM g GROUP BY doc_id, piece)
      SELECT doc_id, {ad.strip_sql(f"substr({ad.strip_sql('split_part(body, chr(10), 1)')}, 3)")} AS title, body FROM p WHERE starts_with({ad.strip_sql('split_part(body, chr(10), 1)')}, '# ')""",
    "split_h2": rf"""WITH {ad.MD_LINES_SQL}, g AS (SELECT *, count(*) FILTER (regexp_matches(line, '^##{_WS}')) OVER (PARTITION BY doc_id ORDER BY pos) AS piece FROM ml),
      p AS (SELECT doc_id, piece, string_agg(line, chr(10) ORDER BY pos) || CASE WHEN piece < max(piece) OVER (PARTITION BY doc_id) THEN chr(10) ELSE '' END AS body FROM g GROUP BY doc_id, piece),
      t AS (SELECT *, split_part(body, chr(10), 1) AS head FROM p)
      SELECT doc_id, {ad.strip_sql(f"regexp_replace(head, '^##{_WS}+', '')")} AS title, regexp_replace(body, '^##{_WS}+', '# ') AS body FROM t WHERE regexp_matches(head, '^##{_WS}+.+$')""",
    "dict_match_counts": f"WITH {ad.matches_sql('documents')} SELECT alias, count(*) AS n, sum(s)::BIGINT AS sum_start, count(DISTINCT doc_id) AS n_docs FROM m GROUP BY alias",
    "skip_offsets": f'WITH {ad.MARKED_SQL}, {ad.SKIPS_SQL} SELECT doc_id, s AS start, e AS "end" FROM reg',
    "span_resolve": f"""WITH {ad.SPANS_SQL} SELECT doc_id, count(s) AS n_spans, coalesce(sum(s), 0)::BIGINT AS starts, coalesce(sum(e), 0)::BIGINT AS ends FROM documents LEFT JOIN span USING (doc_id) GROUP BY doc_id""",
    "annotation_table": f"WITH {ad.SPANS_SQL} SELECT doc_id, min(s) AS start, alias, concept_name, concept_id, alias_type, label, confidence FROM span GROUP BY ALL",
    "annotated_inline": f"""WITH {ad.SPANS_SQL},
      link AS (SELECT *, substr(mk.text, lag(e, 1, 0) OVER p + 1, s - lag(e, 1, 0) OVER p) || CASE WHEN alias = concept_name THEN '[[' || alias || ']]' ELSE '[[' || concept_name || '|' || alias || ']]' END AS part FROM span JOIN mk USING (doc_id) WINDOW p AS (PARTITION BY doc_id ORDER BY s)),
      body AS (SELECT doc_id, string_agg(part, '' ORDER BY s) AS body, max(e) AS last FROM link GROUP BY doc_id),
      entry AS (SELECT doc_id, min(s) AS s, printf('| `%s` | **%s** | %s | %s | %.3f |', alias, concept_name, concept_id, label, confidence) || chr(10) AS line FROM span GROUP BY doc_id, alias, concept_name, concept_id, label, confidence),
      tab AS (SELECT doc_id, string_agg(line, '' ORDER BY s) AS lines FROM entry GROUP BY doc_id)
      SELECT doc_id, CASE WHEN body IS NULL THEN text || '{annotate.NO_MATCH}' ELSE body || substr(text, last + 1) || '{annotate.TABLE_HEAD}' || lines END AS annotated FROM mk LEFT JOIN body USING (doc_id) LEFT JOIN tab USING (doc_id)""",
    "span_ranges": f"WITH {ad.CUTS_SQL} SELECT doc_id, c.s AS start, c.e AS \"end\" FROM chosen",
    "align_edges": f"WITH {ad.EDGES_SQL} SELECT * FROM edges",
    "align_rerun": f"WITH {ad.EDGES_SQL} SELECT * FROM edges",
    "judge_prompt": f"{_VEC} SELECT alias, 'LLM:' || decision || '|' || substr(repeat(best, 60), 1, 300) AS llm_reason FROM judged WHERE similarity >= 0.3 AND alias_type <> 'alias'",
    "alias_lines": f"""{_VEC} SELECT alias, CASE status WHEN 'auto_mapped' THEN '✓' WHEN 'llm_confirmed' THEN '✓' ELSE '?' END || ' ' || chr(39) || alias || chr(39) || ' (' || alias_type || ') ' || CASE WHEN x.concept_id IS NULL THEN '→ (无匹配)' ELSE '→ [' || x.concept_id || '] ' || c.name END
      || ' [' || status || printf('] conf=%.3f', confidence) AS line FROM aligned x LEFT JOIN c USING (concept_id)""",
    "default_lists": f"""WITH {ad.SEGMENTS_SQL},
      seg2 AS (SELECT * REPLACE (CASE WHEN ordinal % 2 = 0 THEN aliases END AS aliases, CASE WHEN ordinal % 3 = 0 THEN entities END AS entities, CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS source) FROM seg),{ad.ALIASES_SQL.replace("FROM seg", "FROM seg2")}
      SELECT * FROM ali""",
    "skip_ranges": r"""SELECT doc_id, (len(regexp_extract_all(text, '(?s)```.*?```')) + len(regexp_extract_all(text, '(?s)\$\$.*?\$\$')) + len(regexp_extract_all(text, '`[^`]+`'))
      + len(regexp_extract_all(text, '\$[^$\n]+?\$')) + len(regexp_extract_all(text, '!\[.*?\]\(.*?\)')))::BIGINT AS n_skips FROM documents""",
}


QUERIES |= files.QUERIES
ORACLES |= files.ORACLES
ORACLES["bucketed_aliases"] = ORACLES["incremental_aliases"]


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
