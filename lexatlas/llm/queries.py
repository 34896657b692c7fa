"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexatlas.llm.bpe import op9_bpe_round_trip
from lexatlas.llm.clustering import OP13_SQL, op13_centroid_clusters
from lexatlas.llm.htmltext import op6_html_text
from lexatlas.llm.langid import op10_language_id
from lexatlas.llm.media import op2_media_tiles
from lexatlas.llm.mixing import op1_mix_sources
from lexatlas.llm.phrases import OP12_SQL, op12_phrases
from lexatlas.llm.quality import op11_quality
from lexatlas.llm.secrets import op8_secret_scan, op8_sql
from lexatlas.llm.simhash import op3_simhash_dedup
from lexatlas.llm.tokenbin import op4_token_store
from lexatlas.llm.topk import OP7_SQL, op7_top_products
from lexatlas.llm.warc import OP5_SQL, op5_warc_revisits


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_media_tiles": op2_media_tiles,
        "op3_simhash_dedup": op3_simhash_dedup,
        "op4_token_store": op4_token_store,
        "op5_warc_revisits": op5_warc_revisits,
        "op6_html_text": op6_html_text,
        "op7_top_products": op7_top_products,
        "op8_secret_scan": op8_secret_scan,
        "op9_bpe_round_trip": op9_bpe_round_trip,
        "op10_language_id": op10_language_id,
        "op11_quality": op11_quality,
        "op12_phrases": op12_phrases,
        "op13_centroid_clusters": op13_centroid_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc_revisits": OP5_SQL,
        "op7_top_products": OP7_SQL,
        "op8_secret_scan": op8_sql(),
        "op12_phrases": OP12_SQL,
        "op13_centroid_clusters": OP13_SQL,
    }
