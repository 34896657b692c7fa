"""A training corpus from `documents`, in five stages. Each is written as Parquet and read again as the next one's docs.

1 language_id    drops documents without a language (null text or no letter); trained on the labelled rows of its own docs
2 near_dedup     keeps one document of each group of SimHash near duplicates (4-word shingles, 4 bits: the operator's contract)
3 secret_scan    replaces every secret in a text by [SECRET]
4 source_mix     repeats or drops documents so that sources reach their target weights in words
5 bpe            encodes and decodes each text: its columns are the documents' and n_tokens, ids, round_trip
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.llm import bpe, langid, mixing, secrets, simhash
from lexatlas.llm.common import columns, own, staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs)
    return langid.keep_identified(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, weights=(5.0, 2.0, 1.0), cap=3.0, share=1.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with n_tokens, ids and round_trip (whether the ids decode to the text again); these replace columns of such names."""
    x, made = own(docs), ("n_tokens", "ids", "round_trip")
    d = bpe.bpe_round_trip(docs, bpe.byte_bpe_path(), to=f"{x}bpe")
    ids = F.col(f"{x}bpe.ids")
    return d.select(*columns(c for c in docs.columns if c.lower() not in made), F.size(ids).cast("long").alias("n_tokens"), ids.alias("ids"), F.col(f"{x}bpe.same").alias("round_trip"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("source_mix", source_mix), ("bpe", encode)]

#: No SQL: stages 1, 2, 4 and 5 can't be expressed; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for stage, step in STAGES[:-1]:
        docs = staged(step(spark, docs, sf_dir), f"pipeline-{stage}")
    return STAGES[-1][1](spark, docs, sf_dir)
