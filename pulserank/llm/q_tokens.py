"""op2: token counts of documents."""
from __future__ import annotations

from pulserank.llm.common import read
from pulserank.llm.unigram_trie import count_tokens


def op2_token_counts(spark, sf_dir):
    return count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_pretokens", "n_tokens")
