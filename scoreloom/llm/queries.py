"""Importing this module fills the register."""

from scoreloom.llm import (  # noqa: F401
    queries_bpe,
    queries_exact_dedup,
    queries_hard_negatives,
    queries_licenses,
    queries_minhash,
    queries_packing,
    queries_pii,
    queries_quality,
    queries_ranked_search,
    queries_repeats,
    queries_sharding,
    queries_toxicity,
    queries_url_filter,
)
from scoreloom.llm.register import ORACLES, QUERIES, register

import corpus_pipeline  # isort: skip  (it uses the operators above)

register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
