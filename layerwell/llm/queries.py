"""Registered queries of the corpus operators, with DuckDB oracles where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from layerwell.llm import (
    chat, exact_dedup, language, licenses, mixing, near_dedup, neighbours, packing, pii, prefix_trie, quality, token_alignment, toxicity,
)
from layerwell.llm.sql import ORACLES  # noqa: F401


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pack(spark, sf_dir):
    return packing.pack(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def _align(spark, sf_dir):
    names = ["byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"]
    return token_alignment.align(_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, names))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_toxicity": lambda s, d: toxicity.toxicity_report(_table(s, d, "documents"), _table(s, d, "labels")),
    "op10_quality": lambda s, d: quality.quality_report(_table(s, d, "documents"), _table(s, d, "labels")),
    "op11_prefix_trie": lambda s, d: prefix_trie.conversation_trie(_table(s, d, "conversations")),
    "op12_license_scan": lambda s, d: licenses.license_report(_table(s, d, "documents")),
    "op13_token_alignment": _align,
    "op2_best_fit_packing": _pack,
    "op3_nearest_neighbours": lambda s, d: neighbours.search(_table(s, d, "embeddings"), F.col("vec_id") % 20 == 0),
    "op4_source_mixing": lambda s, d: mixing.mix_report(_table(s, d, "documents")),
    "op5_personal_data": lambda s, d: pii.pii_report(_table(s, d, "documents")),
    "op6_exact_dedup": lambda s, d: exact_dedup.duplicate_report(_table(s, d, "documents")),
    "op7_chat_perspectives": lambda s, d: chat.perspectives(_table(s, d, "conversations")),
    "op8_language_id": lambda s, d: language.language_report(_table(s, d, "documents")),
    "op9_near_dedup": lambda s, d: near_dedup.near_duplicates(_table(s, d, "documents")),
}
