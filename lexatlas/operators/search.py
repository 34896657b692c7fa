"""Queries over the concept base: listings, review, text and semantic search, manual assignment."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas.functions.text import fixed, lookup, preview
from lexatlas.functions.vectors import blocks, cosine_to, meet, unit_rows, usable
from lexatlas.workers import ready_python

#: Fixed values of the displays.
ICONS = {"auto_mapped": "✓", "llm_confirmed": "✓", "needs_review": "?", "unmapped": "✗", "pending": "○"}
NO_CONCEPT = "→ (无匹配)"


def list_concepts(concepts: DataFrame) -> DataFrame:
    return concepts.select("concept_id", "name", "concept_type", "file_path").orderBy("concept_id")


def _joined(aliases: DataFrame, concepts: DataFrame) -> DataFrame:
    names = concepts.select("concept_id", F.col("name").alias("concept_name"))
    return aliases.join(names, "concept_id", "left").select("alias", "alias_type", "concept_id", "concept_name", "confidence", "status", "llm_reason")


def list_aliases(aliases: DataFrame, concepts: DataFrame, status: str | None = None) -> DataFrame:
    """Aliases with their concept's name, in binary order of the alias."""
    chosen = aliases if status is None else aliases.where(F.col("status") == status)
    return _joined(chosen, concepts).drop("llm_reason").orderBy("alias")


def needs_review(aliases: DataFrame, concepts: DataFrame) -> DataFrame:
    return _joined(aliases.where("status = 'needs_review'"), concepts).drop("status").orderBy(F.desc("confidence"), "alias")


def search_alias(aliases: DataFrame, concepts: DataFrame, query: str) -> DataFrame:
    """Aliases that contain the query, letters in either case; % and _ in it are wildcards."""
    return _joined(aliases.where(F.lower("alias").like(f"%{query.lower()}%")), concepts).drop("llm_reason").orderBy(F.desc("confidence"), "alias")


def displayed(rows: DataFrame) -> DataFrame:
    """rows of list_aliases with `line`, their display."""
    shown = F.when(F.coalesce("concept_id", F.lit("")) != "", F.format_string("→ [%s] %s", "concept_id", F.coalesce("concept_name", F.lit("None")))).otherwise(NO_CONCEPT)
    line = F.format_string("%s '%s' (%s) %s [%s] conf=%s", lookup(F.col("status"), ICONS, "?"), "alias", "alias_type", shown, "status", fixed("confidence"))
    return rows.withColumn("line", line)


def search_vectors(rows: DataFrame, query: list[float], k: int = 5, *, key: str = "concept_id", vector: str = "embedding") -> DataFrame:
    """The k rows most similar to the query, ties by key; rows whose vector isn't usable or has another dimension take no part, nor does
    a query that isn't. A top-k plan: no full sort."""
    ok = usable(F.col(vector)) & (F.size(vector) == len(query)) if all(map(math.isfinite, query)) else F.lit(False)
    return rows.where(ok).withColumn("similarity", cosine_to(query, F.col(vector))).orderBy(F.desc("similarity"), key).limit(k)


def search_text(rows: DataFrame, query: str, encode, k: int = 5, *, key: str = "concept_id") -> DataFrame:
    """search_vectors for a text; encode: text -> list of floats. Contents are shown as previews."""
    found = search_vectors(rows, encode(query), k, key=key)
    return found.withColumn("content", preview("content")) if "content" in found.columns else found


def search_many(queries: DataFrame, rows: DataFrame, k: int = 5, *, query_key: str, key: str, vector: str = "embedding") -> DataFrame:
    """query_key, key, similarity, rank: the k most similar rows for each of the queries, ties (similarities within 1e-12) by key.

    Queries and rows meet in groups of packed blocks, each of which leaves k rows a query. Rows and queries whose vector isn't usable take no part;
    one without length has similarity 0.
    """
    ready_python(rows.sparkSession)
    q = blocks(queries.select(F.col(query_key).alias("q"), F.col(vector).alias("v")), "v")
    r = blocks(rows.select(F.col(key).alias("k"), F.col(vector).alias("v")), "v")
    types = [d.schema[c].dataType.simpleString() for d, c in ((queries, query_key), (rows, key))]

    def run(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"q": [], "k": [], "similarity": []}
        parts = [(unit_rows(b.data, b.dim), b.k) for b in there.itertuples(index=False)]
        for a in asked.itertuples(index=False):
            mine = unit_rows(a.data, a.dim)
            for theirs, keys in parts:
                s = (mine @ theirs.T).round(12)
                least = np.partition(s, max(0, s.shape[1] - k), 1)[:, max(0, s.shape[1] - k)]
                for i in range(len(mine)):
                    at = sorted(np.flatnonzero(s[i] >= least[i]).tolist(), key=lambda j, row=s[i], keys=keys: (-row[j], keys[j]))[:k]
                    out["q"] += [a.q[i]] * len(at)
                    out["k"] += [keys[j] for j in at]
                    out["similarity"] += s[i][at].tolist()
        return pd.DataFrame(out)

    found = meet(q, r, run, f"q {types[0]}, k {types[1]}, similarity double")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("similarity"), "k"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select(F.col("q").alias(query_key), F.col("k").alias(key), "similarity", F.col("rank").cast("int").alias("rank"))


def manual_assign(aliases: DataFrame, concepts: DataFrame, alias: str, concept_id: str) -> tuple[DataFrame, bool]:
    """aliases with one of them confirmed for a concept, and whether both exist; if not, nothing changes."""
    ok = not concepts.where(F.col("concept_id") == concept_id).isEmpty() and not aliases.where(F.col("alias") == alias).isEmpty()
    return (assigned(aliases, alias, concept_id) if ok else aliases), ok


def assigned(aliases: DataFrame, alias: str, concept_id: str) -> DataFrame:
    this = F.col("alias") == alias
    values = {"concept_id": concept_id, "status": "llm_confirmed", "llm_reason": "人工指定"}
    return aliases.withColumns({c: F.when(this, v).otherwise(F.col(c)) for c, v in values.items()})
