"""Queries of the pipeline operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import op10_bpe_encode_decode
from tidemark.llm.divergence import SQL as DIVERGENCE_SQL
from tidemark.llm.divergence import op11_source_divergence_audit
from tidemark.llm.hnsw import op5_nearest_neighbours
from tidemark.llm.langid import op7_language_id
from tidemark.llm.licenses import op12_license_scan
from tidemark.llm.merkle import SQL as MERKLE_SQL
from tidemark.llm.merkle import op13_merkle_manifest
from tidemark.llm.minhash import op6_document_fingerprints
from tidemark.llm.mixing import SQL as MIXING_SQL
from tidemark.llm.mixing import op1_mixing_sources
from tidemark.llm.quality import op4_quality_classifier
from tidemark.llm.simhash import op3_simhash_near_dedup
from tidemark.llm.substring import op8_substring_dedup
from tidemark.llm.toxicity import op9_toxicity
from tidemark.llm.urls import SQL as URL_SQL
from tidemark.llm.urls import op2_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing_sources": op1_mixing_sources,
    "op2_url_filter": op2_url_filter,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_bpe_encode_decode": op10_bpe_encode_decode,
    "op11_source_divergence_audit": op11_source_divergence_audit,
    "op12_license_scan": op12_license_scan,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL: dict[str, str] = {
    "op1_mixing_sources": MIXING_SQL,
    "op2_url_filter": URL_SQL,
    "op11_source_divergence_audit": DIVERGENCE_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
