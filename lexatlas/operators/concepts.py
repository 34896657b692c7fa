"""Concepts and aliases from segments, and incremental builds of the concept base.

A segment has an `ordinal`, a distinct long that gives its place in the list; first-wins rules and numbers follow it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexatlas.functions.numbering import dense_numbers, first_rows
from lexatlas.functions.text import concept_code, embedding_text, strip
from lexatlas.schemas import ALIASES, CONCEPT_TYPES, CONCEPTS, KNOWLEDGE_SEGMENTS, METADATA, conform

#: Fixed value: the reason of a concept's own name as alias.
SELF_REASON = "概念名本身"


def extract_concepts(segments: DataFrame, first_number: int = 1) -> DataFrame:
    """The first segment of each title among those that define something: concept_id (dense, C001 on), name, file_path, title,
    content, concept_type, created_at, ordinal."""
    named = segments.where(F.col("type").isin(*CONCEPT_TYPES)).select(
        strip(F.coalesce("title", F.lit(""))).alias("name"), F.coalesce("source", F.lit("")).alias("file_path"), F.coalesce("content", F.lit("")).alias("content"),
        F.col("type").alias("concept_type"), F.coalesce("created_at", F.lit("")).alias("created_at"), "ordinal",
    )
    found = dense_numbers(first_rows(named.where("name <> ''"), ["name"], ["ordinal"]), "n", "ordinal")
    return found.select(concept_code(F.col("n") + F.lit(first_number - 1)).alias("concept_id"), "name", "file_path", F.col("name").alias("title"), "content", "concept_type", "created_at", "ordinal")


def extract_aliases(segments: DataFrame) -> DataFrame:
    """The first occurrence of each alias (of defining segments) and entity (comma-separated, of all): alias, block_id, alias_type,
    source_doc, created_at. Aliases and entities share one namespace."""
    base = [F.col("ordinal").alias("block_id"), F.coalesce("source", F.lit("")).alias("source_doc"), F.coalesce("created_at", F.lit("")).alias("created_at")]
    own = segments.where(F.col("type").isin(*CONCEPT_TYPES)).select(*base, F.posexplode(F.coalesce("aliases", F.array().cast("array<string>"))).alias("at", "alias"), F.lit("alias").alias("alias_type"), F.lit(0).alias("kind"))
    parts = F.transform(F.split(F.coalesce("entities", F.lit("")), ","), strip)
    entities = segments.select(*base, F.posexplode(parts).alias("at", "alias"), F.lit("entity").alias("alias_type"), F.lit(1).alias("kind"))
    every = own.unionByName(entities).where("alias is not null and alias <> ''")
    return first_rows(every, ["alias"], ["block_id", "kind", "at"]).select("alias", "block_id", "alias_type", "source_doc", "created_at")


def new_rows(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """rows whose key isn't in existing yet."""
    return rows.join(existing.select(key).distinct(), key, "left_anti").select(rows.columns)


def upsert(existing: DataFrame, *later: DataFrame, key: str) -> DataFrame:
    """Rows by key; of equal keys the last frame's wins."""
    every = existing.withColumn("__p", F.lit(0))
    for k, df in enumerate(later, 1):
        every = every.unionByName(df.select(existing.columns).withColumn("__p", F.lit(k)))
    return first_rows(every, [key], [-F.col("__p")]).drop("__p")


def increment_rows(segments: DataFrame, concepts: DataFrame | None = None, aliases: DataFrame | None = None, embed=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What segments add to a base: new concepts, alias rows of their own names, and new aliases and entities, which replace those of the same
    name. Nothing that is there changes, but an own name's row counts only if the alias isn't there yet.

    embed: a column function text -> array<float>, or None to leave embeddings null. New concepts continue the numbers.
    """
    spark = segments.sparkSession
    concepts = spark.createDataFrame([], CONCEPTS) if concepts is None else conform(concepts, CONCEPTS)
    aliases = spark.createDataFrame([], ALIASES) if aliases is None else conform(aliases, ALIASES)
    vector = (lambda text: embed(text)) if embed else (lambda text: F.lit(None).cast("array<float>"))
    last = concepts.agg(F.coalesce(F.max(F.regexp_extract("concept_id", r"^C(\d+)$", 1).try_cast("long")), F.lit(0)).alias("m")).first()["m"]
    # numbers go to what is new, after the highest there is
    known = concepts.select(F.col("name").alias("__name")).distinct()
    fresh = segments.join(known, strip(F.coalesce("title", F.lit(""))) == F.col("__name"), "left_anti")
    added = extract_concepts(fresh, int(last) + 1)
    added = conform(added.withColumn("embedding", vector(embedding_text("title", "content"))), CONCEPTS)
    found = new_rows(extract_aliases(segments), aliases, "alias")
    found = conform(
        found.withColumns({"confidence": F.lit(0.0), "status": F.lit("pending"), "embedding": vector(F.col("alias"))}), ALIASES
    )
    own = added.select(
        F.col("name").alias("alias"), "concept_id", F.lit("concept").alias("alias_type"), F.col("file_path").alias("source_doc"), F.lit(1.0).alias("confidence"),
        F.lit("auto_mapped").alias("status"), F.lit(SELF_REASON).alias("llm_reason"), "created_at", "embedding",
    )
    return added, conform(new_rows(own, aliases, "alias"), ALIASES), found


def build_base(segments: DataFrame, concepts: DataFrame | None = None, aliases: DataFrame | None = None, embed=None) -> tuple[DataFrame, DataFrame]:
    """The whole concept base after an increment: (concepts, aliases). See increment_rows."""
    spark = segments.sparkSession
    concepts = spark.createDataFrame([], CONCEPTS) if concepts is None else conform(concepts, CONCEPTS)
    aliases = spark.createDataFrame([], ALIASES) if aliases is None else conform(aliases, ALIASES)
    added, own, found = increment_rows(segments, concepts, aliases, embed)
    return upsert(concepts, added, key="concept_id"), upsert(aliases, own, found, key="alias")


def knowledge_segments(segments: DataFrame, embed=None) -> DataFrame:
    """The store of segments for semantic search: dense ids in list order, `references` as refs, embeddings of title and content."""
    numbered = dense_numbers(segments, "id", "ordinal")
    if "references" in numbered.columns:
        numbered = numbered.withColumn("refs", F.col("references"))
    text = embedding_text("title", "content")
    return conform(numbered.withColumn("embedding", embed(text) if embed else F.lit(None).cast("array<float>")), KNOWLEDGE_SEGMENTS)


def text_view(stored: DataFrame) -> DataFrame:
    """KNOWLEDGE_SEGMENTS as the text store shows them: lists as JSON, flags as 0 and 1, the vector's size in bytes."""
    flag = F.col("needs_review").cast("int")
    return stored.withColumns({"aliases": F.to_json("aliases"), "refs": F.to_json("refs"), "needs_review": flag, "embedding_bytes": F.size("embedding") * 4}).drop("embedding")


def metadata(segments: DataFrame, model: str) -> DataFrame:
    """key, value: the model, an empty creation time, the number of segments."""
    rows = [F.struct(F.lit("embedding_model").alias("key"), F.lit(model).alias("value")), F.struct(F.lit("created_at").alias("key"), F.lit("").alias("value"))]
    count = segments.agg(F.count(F.lit(1)).alias("n"))
    rows.append(F.struct(F.lit("total_segments").alias("key"), F.col("n").cast("string").alias("value")))
    return conform(count.select(F.inline(F.array(*rows))), METADATA)


def type_counts(segments: DataFrame) -> DataFrame:
    """type (missing: unknown), n, first_position; in order of first appearance."""
    return segments.groupBy(F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first_ordinal"))
