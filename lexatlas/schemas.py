"""Schemas of the knowledge base, its enumerations, and a validator for the constraints that Parquet doesn't enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_ATOMS = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType()}


def _parts(text: str) -> list[str]:
    """text cut at the commas outside of angle brackets."""
    out, depth = [""], 0
    for ch in text:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return [p.strip() for p in out]


def _type(text: str) -> T.DataType:
    kind, inner = text.partition("<")[0].strip(), text.partition("<")[2].rpartition(">")[0]
    if kind == "array":
        return T.ArrayType(_type(inner))
    if kind == "struct":
        return T.StructType([T.StructField(n.strip().strip("`"), _type(t)) for n, _, t in (p.partition(":") for p in _parts(inner))])
    return _ATOMS[kind]


def _struct(ddl: str) -> T.StructType:
    """A schema from `name type, ...`, without the session that Spark's own parser needs."""
    return T.StructType([T.StructField(n.strip("`"), _type(t)) for n, _, t in (p.partition(" ") for p in _parts(ddl))])


#: Fixed values of the data model.
CONCEPT_TYPES = ("concept", "definition", "theorem")
SEGMENT_TYPES = ("concept", "theorem", "proof", "example", "note", "definition")
ALIAS_TYPES = ("alias", "entity", "concept")
STATUSES = ("pending", "auto_mapped", "llm_confirmed", "needs_review", "unmapped")
CONFIRMED = ("auto_mapped", "llm_confirmed")

CHAPTERS = _struct("id long, level int, number string, title string, parent_id long")
CONCEPTS = _struct("concept_id string, name string, file_path string, title string, content string, concept_type string, created_at string, embedding array<float>")
ALIASES = _struct("alias string, block_id long, concept_id string, alias_type string, source_doc string, confidence double, status string, llm_reason string, created_at string, embedding array<float>")
METADATA = _struct("key string, value string")
SEGMENT = _struct(
    "source string, section string, section_id string, position int, title string, content string, raw_content string, type string, aliases array<string>, entities string, "
    "references array<string>, confidence double, needs_review boolean, summary string, created_at string, model string, version int, embedding array<float>"
)
KNOWLEDGE_SEGMENTS = _struct(
    "id long, source string, section string, section_id string, position int, title string, content string, raw_content string, type string, aliases array<string>, entities string, "
    "refs array<string>, confidence double, needs_review boolean, summary string, created_at string, embedding array<float>"
)
LEGACY_SEGMENT = _struct("textbook_id int, chapter_id string, knowledge_node_id string, segment_type string, title string, content string, alias_names string, tags string")
TOC = _struct("structure_summary struct<`层级数量`:int,`层级定义`:array<struct<level:int,`编号格式`:string,`层级名称`:string>>>, chapters array<struct<level:int,`编号`:string,`标题`:string,title:string,`父级编号`:string>>")


def legacy_segments(legacy: DataFrame) -> DataFrame:
    """Segments of the old schema under the names of the current one."""
    split = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return legacy.select(
        F.col("textbook_id").cast("string").alias("source"), F.col("chapter_id").alias("section"), "title", "content", F.col("segment_type").alias("type"),
        split(F.col("alias_names")).alias("aliases"), F.col("tags").alias("entities"),
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the columns of schema: missing ones null, others dropped, types cast."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def constraint_report(concepts: DataFrame, aliases: DataFrame) -> DataFrame:
    """rule, violations: primary keys, enumerations, NOT NULL, foreign key."""

    def row(rule: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")

    rules = [
        row("concepts.concept_id unique", concepts.groupBy("concept_id").count().where("count > 1")),
        row("concepts.name not null", concepts.where("name is null")),
        row("aliases.alias unique", aliases.groupBy("alias").count().where("count > 1")),
        row("aliases.alias_type known", aliases.where(~F.coalesce(F.col("alias_type").isin(*ALIAS_TYPES), F.lit(True)))),
        row("aliases.status known", aliases.where(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(True)))),
        row("aliases.concept_id refers to a concept", aliases.where("concept_id is not null").join(concepts.select("concept_id").distinct(), "concept_id", "left_anti")),
    ]
    return reduce(DataFrame.unionByName, rules)
