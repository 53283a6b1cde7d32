"""op11: texts encoded and decoded by a rank file, as digests."""
from __future__ import annotations

from pulserank.llm.common import read
from pulserank.llm.duck_bpe import digests, round_trip


def op11_duck_bpe(spark, sf_dir):
    return digests(round_trip(read(spark, sf_dir, "documents").select("doc_id", "text")))
