"""Queries of this subpackage and their SQL twins."""

from pressmill.llm import (
    chat_format,
    cross_polytope,
    disclosure,
    fill_middle,
    html_blocks,
    interleave,
    line_dedup,
    lsh_forest,
    merkle,
    nnls_packing,
    speculative_bpe,
    token_alignment,
    toxicity,
)

_MODULES = (
    html_blocks,
    cross_polytope,
    chat_format,
    merkle,
    lsh_forest,
    interleave,
    toxicity,
    disclosure,
    nnls_packing,
    speculative_bpe,
    token_alignment,
    line_dedup,
    fill_middle,
)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
