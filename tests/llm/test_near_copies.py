"""Near copies are what a comparison of all pairs by five-word shingles finds."""
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulserank.llm.near_copies import similar_groups
from pulserank.llm.simhash import fingerprint, near_groups

SCHEMA = "doc_id long, text string"


def _words(rng, n):
    return ["w" + str(rng.randrange(4000)) for _ in range(n)]


def _planted():
    """Texts of 50 to 300 words with 1 to 9 words replaced, a run of copies of copies, and a passage that many share."""
    rng, texts = random.Random(4), []
    passage = _words(rng, 20)
    for n in (50, 100, 300):
        for changes in (1, 2, 3, 6, 9):
            for _ in range(6):
                words = _words(rng, n)
                texts.append(words)
                copy = list(words)
                for at in rng.sample(range(n), changes):
                    copy[at] = "new" + str(rng.randrange(10**6))
                texts.append(copy)
    chain = _words(rng, 120)
    for i in range(60):
        chain = [*chain[2:], *_words(rng, 2)]
        texts.append(chain)
    texts += [_words(rng, 15) + passage + _words(rng, 15) for _ in range(30)]
    return [*(" ".join(t) for t in texts), None, "", " ", "One two", "one  TWO"]


def _brute(texts):
    sets, group = [], list(range(len(texts)))
    for t in texts:
        words = (t or "").lower().split()
        size = min(5, len(words))
        sets.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set())
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= 0.8 * len(a | b):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return dict(enumerate(group))


@pytest.mark.parametrize("block", [256, 8])
def test_similar_groups_are_those_of_all_pairs(spark, block):
    texts = _planted()
    want = _brute(texts)
    assert sum(want[i] != i for i in want) > 100
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.doc_id: r.component_id for r in similar_groups(frame, block=block, task_rows=20).collect()}
    assert got == want


def test_the_stage_drops_near_copies(spark, tmp_path):
    texts = _planted()
    want = {i for i, g in _brute(texts).items() if i == g}
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")})
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()} == want


def test_near_groups_heeds_words_and_seed(spark):
    frame = spark.createDataFrame([(1, "a b c d e f g h")], SCHEMA)
    row = near_groups(frame, words=5, seed=7).first()
    assert row.fingerprint % (1 << 64) == fingerprint("a b c d e f g h", 5, 7) != fingerprint("a b c d e f g h")
