"""Alias alignment: the best concept for each alias by cosine similarity, then a decision table with a pluggable judge."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexatlas.functions.vectors import BLOCK, blocks, meet, unit_rows
from lexatlas.schemas import CONCEPTS, conform
from lexatlas.scratch import staged
from lexatlas.workers import ready_python

HIGH, MIDDLE = "高关联", "中关联"


def best_match(aliases: DataFrame, concepts: DataFrame, *, alias_key: str = "alias", concept_key: str = "concept_id", order: str | None = None, vector: str = "embedding") -> DataFrame:
    """alias_key, best (a concept's key), similarity: the concept of highest cosine similarity above 0, ties to the smaller `order`.

    Both sides are packed into blocks and laid down in groups; pairs of groups meet in matrix products, each of which leaves one best concept an
    alias, so memory is bounded by two groups, disk grows with the vectors, and nothing is broadcast. Rows whose vector is null, empty or not finite, or has no length, have no match and no row.
    Similarities within 1e-12 of each other are ties.
    """
    ready_python(aliases.sparkSession)
    order = order or concept_key
    left = blocks(aliases.select(F.col(alias_key).alias("k"), F.col(vector).alias("v")), "v")
    right = blocks(concepts.select(F.col(order).alias("o"), F.col(concept_key).alias("c"), F.col(vector).alias("v")), "v")
    types = {c: d.schema[x].dataType.simpleString() for c, d, x in (("k", aliases, alias_key), ("o", concepts, order), ("c", concepts, concept_key))}

    def run(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        orders, concepts = ([x for r in c[k] for x in r] for k in ("o", "c"))
        at = sorted(range(len(orders)), key=lambda i: (orders[i], concepts[i]))
        chunks = [np.array(at[i : i + BLOCK]) for i in range(0, len(at), BLOCK)]
        out: dict[str, list] = {"k": [], "o": [], "c": [], "similarity": []}
        if not len(a) or not chunks:
            return pd.DataFrame(out)
        vectors = np.concatenate(list(c["data"])).reshape(len(orders), -1)
        for r in a.itertuples(index=False):
            mine = unit_rows(r.data, r.dim)
            top, tops, best = np.zeros(len(mine)), np.zeros((len(chunks), len(mine))), np.zeros((len(chunks), len(mine)), np.int64)
            for j, chunk in enumerate(chunks):
                s = mine @ unit_rows(vectors[chunk], r.dim).T
                tops[j] = s.max(1)
                near = np.flatnonzero(tops[j] >= top - 1e-12)
                best[j, near] = chunk[(s[near] >= tops[j, near, None] - 1e-12).argmax(1)]
                top = np.maximum(top, tops[j])
            first = (tops >= top - 1e-12).argmax(0)  # chunks are in the order of concepts
            for i in np.flatnonzero(top > 0):
                k = best[first[i], i]
                out["k"].append(r.k[i])
                out["o"].append(orders[k])
                out["c"].append(concepts[k])
                out["similarity"].append(top[i])
        return pd.DataFrame(out)

    found = meet(left, right, run, f"k {types['k']}, o {types['o']}, c {types['c']}, similarity double")
    tops = found.groupBy("k").agg(F.max("similarity").alias("top"), F.collect_list(F.struct("similarity", "o", "c")).alias("all"))  # one entry a group of concepts
    near = F.array_min(F.transform(F.filter("all", lambda x: x["similarity"] >= F.col("top") - 1e-12), lambda x: F.struct(x["o"], x["c"])))
    return tops.select(F.col("k").alias(alias_key), near["c"].alias("best"), F.col("top").alias("similarity"))


def short_reason(similarity: Column, threshold: float) -> Column:
    return F.format_string("向量相似度不足(%.3f<%s)", similarity, F.lit(str(threshold)))


def no_vector() -> Column:
    return F.col("embedding").isNull() | (F.size("embedding") == 0)


def decide(rows: DataFrame, threshold: float = 0.75) -> DataFrame:
    """rows: an alias with embedding, best, similarity, and the judge's decision and reason (used where similarity reaches the
    threshold and the type isn't alias). Sets status, concept_id, confidence and llm_reason by the decision table."""
    none = F.col("__none") if "__none" in rows.columns else no_vector()
    alias, has, sim = F.col("alias_type") == "alias", F.col("best").isNotNull(), F.coalesce("similarity", F.lit(0.0))
    near = has & (sim >= threshold)
    high = F.col("decision") == HIGH
    said = F.concat(F.lit("LLM:"), F.coalesce("decision", F.lit("无关联")), F.lit("|"), F.coalesce("reason", F.lit("")))
    below = F.when(alias | has, short_reason(sim, threshold)).otherwise("无匹配概念")
    return rows.withColumns({
        "status": F.when(none, "unmapped").when(near & alias, "auto_mapped").when(near & high, "llm_confirmed").otherwise("needs_review"),
        "concept_id": F.when(none, F.col("concept_id")).when(near & (alias | high), F.col("best")).when(~near & alias, F.col("best")),
        "confidence": F.when(none, F.col("confidence")).when(has, sim).otherwise(0.0),
        "llm_reason": F.when(none, F.col("llm_reason")).when(near & alias, f"向量匹配(阈值{threshold})").when(near, said).otherwise(below),
    })


def align(aliases: DataFrame, concepts: DataFrame, judge, *, threshold: float = 0.75, rerun: bool = False, order: str | None = None) -> DataFrame:
    """aliases after alignment of the pending ones (with rerun: of all entities, reset first). judge: a function of a DataFrame
    (alias, name, content) that adds decision and reason; it sees only what the decision needs."""
    now = reset_entities(aliases) if rerun else aliases
    chosen = F.col("alias_type") == "entity" if rerun else F.col("status") == "pending"
    chosen = F.coalesce(chosen, F.lit(False))
    open_rows, rest = now.where(chosen), now.where(~chosen)
    # laid down: it is read three times, and a second alignment on top of this one would match again each time
    best = staged(best_match(open_rows, concepts, order=order), "best")
    # told before the joins, which so don't shuffle vectors that the result isn't asked for
    found = open_rows.withColumn("__none", no_vector()).join(best, "alias", "left")
    asked = found.where((F.col("similarity") >= threshold) & (F.col("alias_type") != "alias")).select("alias", F.col("best").alias("concept_id"))
    asked = asked.join(conform(concepts, CONCEPTS).select("concept_id", "name", F.substring("content", 1, 300).alias("content")), "concept_id").select("alias", "name", "content")
    answers = judge(asked).select("alias", "decision", "reason")
    done = decide(found.join(answers, "alias", "left"), threshold)
    return done.select(aliases.columns).unionByName(rest)


def reset_entities(aliases: DataFrame) -> DataFrame:
    """Entities as before any alignment."""
    entity = F.coalesce(F.col("alias_type") == "entity", F.lit(False))
    values = {"status": F.lit("pending"), "concept_id": F.lit(None).cast("string"), "confidence": F.lit(0.0), "llm_reason": F.lit(None).cast("string")}
    return aliases.withColumns({c: F.when(entity, v).otherwise(F.col(c)) for c, v in values.items()})


def outcome_counts(aligned: DataFrame) -> DataFrame:
    """One row: auto_mapped, llm_confirmed, llm_rejected, needs_review, unmapped. Rejected: any answer of the judge but the two
    upper ones; these rows are stored as needs_review and not counted there."""
    s, reason = F.col("status"), F.coalesce("llm_reason", F.lit(""))
    rejected = (s == "needs_review") & reason.startswith("LLM:") & ~reason.startswith(f"LLM:{MIDDLE}")
    return aligned.agg(
        F.count_if(s == "auto_mapped").alias("auto_mapped"), F.count_if(s == "llm_confirmed").alias("llm_confirmed"), F.count_if(rejected).alias("llm_rejected"),
        F.count_if((s == "needs_review") & ~rejected).alias("needs_review"), F.count_if(s == "unmapped").alias("unmapped"),
    )


def status_counts(aliases: DataFrame) -> DataFrame:
    return aliases.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
