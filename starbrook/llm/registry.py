"""The registered queries of this package, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from starbrook.llm.bpe import op4_byte_bpe
from starbrook.llm.chat import op7_chat_formatting
from starbrook.llm import collocations, divergence
from starbrook.llm.exact_dedup import op2_exact_dedup
from starbrook.llm.licenses import op9_license_scans
from starbrook.llm.lm_scoring import op11_lm_scoring
from starbrook.llm.near_dedup import op6_minhash_near_dedup
from starbrook.llm.packing import op1_best_fit_packing
from starbrook.llm.quality_rules import op10_quality_rules
from starbrook.llm.token_counts import op8_token_counts
from starbrook.llm.toxicity import op5_toxicity
from starbrook.llm.url_filter import op3_url_filter

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_token_counts": op8_token_counts,
    "op9_license_scans": op9_license_scans,
    "pipeline": corpus_pipeline.run,
    "op10_quality_rules": op10_quality_rules,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLES = {
    "op2_exact_dedup": """
        WITH folded AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
            max(doc_id) OVER same AS keep_id,
            count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept,
            text_sha256
        FROM folded WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op12_phrase_collocations": collocations.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
