"""op8: texts encoded and decoded, as digests."""
from __future__ import annotations

from pulserank.llm.bpe_automaton import digests, round_trip
from pulserank.llm.common import read


def op8_bpe(spark, sf_dir):
    return digests(round_trip(read(spark, sf_dir, "documents").select("doc_id", "text")))
