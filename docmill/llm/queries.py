"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docmill.llm.audio import op10_audio_features
from docmill.llm.divergence import ORACLE as DIVERGENCE_SQL
from docmill.llm.divergence import op11_source_divergence
from docmill.llm.fingerprints import op8_fingerprints
from docmill.llm.jaccard import op4_ngram_jaccard
from docmill.llm.langid import op6_language_id
from docmill.llm.licenses import op12_license_scan
from docmill.llm.ngram_lm import op5_lm_score
from docmill.llm.packing import op2_packing
from docmill.llm.recompression import op7_substring_dedup
from docmill.llm.sentencepiece_viterbi import op3_sentencepiece
from docmill.llm.sharding import op1_sharding
from docmill.llm.token_counts import ORACLE as TOKEN_COUNTS_SQL
from docmill.llm.token_counts import op9_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_packing": op2_packing,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_lm_score": op5_lm_score,
    "op6_language_id": op6_language_id,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_counts": op9_token_counts,
    "op10_audio_features": op10_audio_features,
    "op11_source_divergence": op11_source_divergence,
    "op12_license_scan": op12_license_scan,
}
ORACLE_SQL: dict[str, str] = {"op9_token_counts": TOKEN_COUNTS_SQL, "op11_source_divergence": DIVERGENCE_SQL}
