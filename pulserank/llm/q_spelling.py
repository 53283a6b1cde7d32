"""op13: spelling variants of the words in documents."""
from __future__ import annotations

from pulserank.llm.common import read
from pulserank.llm.spelling import variants


def op13_spelling(spark, sf_dir):
    return variants(read(spark, sf_dir, "documents"))
