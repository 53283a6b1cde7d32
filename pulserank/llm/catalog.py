"""The registered queries of this subpackage and their SQL twins."""
from __future__ import annotations

from pulserank.llm import (
    q_bpe, q_collocations, q_decontaminate, q_duck_bpe, q_licenses, q_line_dedup, q_pii, q_secrets, q_simhash, q_spelling, q_tokens, q_toxicity, q_vectors,
)

QUERIES = {
    "op1_vector_dedup": q_vectors.op1_vector_dedup,
    "op2_token_counts": q_tokens.op2_token_counts,
    "op3_licenses": q_licenses.op3_licenses,
    "op4_line_dedup": q_line_dedup.op4_line_dedup,
    "op5_simhash": q_simhash.op5_simhash,
    "op6_decontaminate": q_decontaminate.op6_decontaminate,
    "op7_secrets": q_secrets.op7_secrets,
    "op8_bpe": q_bpe.op8_bpe,
    "op9_pii": q_pii.op9_pii,
    "op10_toxicity": q_toxicity.op10_toxicity,
    "op11_duck_bpe": q_duck_bpe.op11_duck_bpe,
    "op12_collocations": q_collocations.op12_collocations,
    "op13_spelling": q_spelling.op13_spelling,
}
ORACLES = {
    "op1_vector_dedup": q_vectors.SQL,
    "op4_line_dedup": q_line_dedup.SQL,
    "op6_decontaminate": q_decontaminate.SQL,
    "op12_collocations": q_collocations.SQL,
}
