"""Phrase collocations and their quotient filters against plain counts."""
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulserank.llm import collocations as C
from pulserank.llm.quotient_filter import Counter as PairCounter, QuotientFilter, permute, restore

SCHEMA = "doc_id long, text string, lang string, f int, id string"  # the last two clash with inner names


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, least, longest=5, top=2000, cover=100):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", low(text)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                own.update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, own in counts.items():
        some = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = {}
        for p, a in some.items():
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        longer[p[i:j]] = max(longer.get(p[i:j], 0), a)
        found = []
        for p, a in some.items():
            if p in longer and 100 * longer[p] >= cover * a:
                continue
            score, k = min(((1000 * a * totals[lang]) // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def corpus():
    rng = random.Random(11)
    names = ["red", "Fox", "runs", "over", "the", "hill", "ñandú", "\x1cq", "a\xa0b", "ÉTÉ"]
    rows = [(None, "en"), ("", "en"), (" \t ", None), ("...;;\n\n", "fr"), ("one", None)]
    for i in range(160):
        words = [rng.choice(names) for _ in range(rng.randrange(1, 40))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = ["New", "York", "stock", "exchange", "index", "fell"][: rng.choice([2, 5, 6, 6])]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ; "]) for w in words)
        rows.append((text, rng.choice(["en", "en", "en", "fr", None, ""])))
    rows += [("big big " * 400 + "x", "en")] + [rows[-1]] * 3
    rows.append((". ".join("red fox runs over the hill" for _ in range(3000)), "en"))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i % 7 or None, t, g, i, "own") for i, (t, g) in enumerate(corpus())], SCHEMA).repartition(5)


def answers(df):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()}


@pytest.mark.parametrize("broadcast", [1 << 20, -1])
def test_equals_plain_counts(frame, broadcast):
    """Ids by broadcast and by joins give the same rows."""
    got = answers(C.collocations(frame, least=8, broadcast_bytes=broadcast))
    assert got == plain(corpus(), 8) and len(got) > 50


def test_words_of_slices():
    """Texts come as slices of larger batches."""
    texts = [t or "" for t, _ in corpus()]
    whole = pa.array(texts, pa.string())
    for start, size in ((0, 3), (7, 40), (90, 70)):
        row, code, names = C._words(whole.slice(start, size))
        want = [(i, w) for i, t in enumerate(texts[start:start + size]) for w in re.findall("[^\x20\x09]+", re.sub("[.,;:!?\n-\r]", " \n ", low(t)))]
        assert [(i, names[c]) for i, c in zip(row.tolist(), code.tolist())] == want


def test_many_slices_equal_plain_counts(frame, monkeypatch):
    monkeypatch.setattr(C, "_TEXTS", 2000)
    monkeypatch.setattr(C, "_IDS", 3000)
    assert answers(C.collocations(frame.coalesce(1), least=8)) == plain(corpus(), 8)


def test_top_and_cover(frame):
    assert answers(C.collocations(frame, least=5, longest=3, top=4, cover=80)) == plain(corpus(), 5, 3, 4, 80)


def test_segments_of_long_texts(frame, monkeypatch):
    rows = [(t, g) for t, g in corpus()]
    got = {(r.lang, r.phrase): r.f for r in C.frequent_phrases(frame, 8)[0].collect()}
    row, code, names = C._words(pa.array([rows[-1][0]]))
    monkeypatch.setattr(C, "SEGMENT", 10)
    starts = C._cut(row, code == names.index("\n"))
    assert len(starts) > 500 and all(names[code[s]] == "\n" for s in starts[1:])
    assert got["en", "red fox runs over the"] >= 3000


def test_empty_tables(spark, frame):
    assert C.collocations(frame.limit(0)).collect() == []
    assert C.collocations(frame.where("text IS NULL")).collect() == []
    assert C.collocations(frame, least=10 ** 6).collect() == []


@pytest.mark.parametrize("width", [1, 5, 21, 32, 33, 50, 63])
def test_permutation_and_filters_lose_nothing(width):
    rng = np.random.default_rng(width)
    left, right = (rng.integers(0, 1 << width, 3000, dtype=np.uint64) for _ in range(2))
    back = restore(*permute(left, right, width), width)
    assert (back[0] == left).all() and (back[1] == right).all()
    many = rng.integers(0, 40, 20_000)
    counter, shards = PairCounter(width, 3, limit=2500), []
    for part in np.array_split(many, 9):
        shards += counter.add(left[part], right[part])
    hot = np.zeros(70_000, np.int64)
    shards += counter.add(left[hot], right[hot]) + counter.drain()
    shards = [QuotientFilter.from_bytes(f.to_bytes()) for f in shards]
    found = {}
    for bucket in {f.bucket for f in shards}:
        merged = QuotientFilter.from_bytes(QuotientFilter.merge([f for f in shards if f.bucket == bucket]).to_bytes())
        found.update(zip(zip(*(p.tolist() for p in merged.pairs())), merged.counts.tolist()))
    used = np.concatenate([many, hot])
    assert found == dict(Counter(zip(left[used].astype(np.int64).tolist(), right[used].astype(np.int64).tolist())))


def test_filters_are_compact():
    n, width = 200_000, 20
    rng = np.random.default_rng(1)
    counter = PairCounter(width, 0)
    counter.add(rng.integers(0, 1 << width, n), rng.integers(0, 1 << width, n))
    (filled,) = counter.drain()
    assert len(filled.to_bytes()) < 6.5 * n  # 24 bytes as three numbers


def test_batches_of_long_texts_are_small(spark, monkeypatch):
    """Long texts come in batches bounded by bytes, not in the 10,000 rows that Spark puts into one; the session's setting is left as it was."""
    seen, kept = spark.sparkContext.accumulator(0), C.pieces
    def watched(batches, text, limit):
        for batch in batches:
            seen.add(batch.num_rows > 300)
            yield from kept([batch], text, limit)
    monkeypatch.setattr(C, "pieces", watched)
    docs = spark.range(400, numPartitions=1).selectExpr("repeat('one two three. ', 3000) AS text", "'en' AS lang")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for before in (None, "32m"):
        spark.conf.set(name, before) if before else spark.conf.unset(name)
        every, totals = C.frequent_phrases(docs, longest=2)
        assert spark.conf.get(name, None) == before
    spark.conf.unset(name)
    assert {(r.phrase, r.f) for r in every.collect()} == {(p, 1_200_000) for p in ("one", "two", "three", "one two", "two three")}
    assert totals.first()["n"] == 3_600_000 and seen.value == 0
