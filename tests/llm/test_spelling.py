"""Spelling variants against a comparison of all pairs of words."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pulserank.llm import spelling as S

SCHEMA = "doc_id long, text string, word string, n int, key string"  # the last three clash with inner names


def low(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain(rows, every=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, out = {}, {}
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    for w, n in counts.items():
        close = [o for d in (-1, 0, 1) for o in by_length.get(len(w) + d, ()) if near(w, o)]
        best = min(close, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = [n, len(close)]
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] += [form[w], counts.get(form[w]), root]
    return {w: tuple(v) for w, v in out.items()}


def corpus():
    rng = random.Random(21)
    stems = ["".join(rng.choice("aeinrstlü") for _ in range(rng.randrange(4, 9))) for _ in range(60)] + ["Straße", "ÀÉÎÕÜ", "×÷×÷×", "aaaaa", "aaaaaa"]
    rows = [(None, None), (None, "Hello hello hEllo"), (1, ""), (2, "12 34 _ -- 漢字"), (3, "q" * 9000 + " " + "q" * 9001), (4, "q" * 9000), (5, "q" * 9000 + " " + "q" * 9001), (6, "q" * 9001)]
    for i in range(300):
        words = []
        for _ in range(rng.randrange(5, 60)):
            w = rng.choice(stems) if rng.random() < 0.6 else stems[min(int(rng.expovariate(0.4)), 64)]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("aeinZ") + w[at:], w[:at] + rng.choice("aeinö") + w[at + 1:]])
            words.append(w)
        rows.append((i % 250, rng.choice([" ", ", ", "\n", "-"]).join(words)))
    rows.append((400, " ".join(["mountain"] * 64 + ["mountein"] * 20 + ["mountean"] * 6 + ["mounteon"] * 3)))  # a chain of forms
    return rows + [rows[-2]] * 2


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t, "own", 7, "k") for i, t in corpus()], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def expected():
    return plain(corpus())


@pytest.mark.parametrize("tile, groups", [(2048, None), (3, 2), (2, 1), (5, 6)])
def test_equals_all_pairs(frame, expected, tile, groups):
    """Tiles and letter groups change no row."""
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in S.variants(frame, tile=tile, groups=groups).collect()}
    assert got == expected
    assert sum(v[2] is not None for v in got.values()) > 50 and any(v[2] is not None and v[2] != v[4] for v in got.values())


def test_contract_columns(frame):
    assert S.variants(frame).dtypes == [("word", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form", "string"), ("form_n", "bigint"), ("root", "string")]


def test_deleted_letters(frame, expected):
    got = {r.word: r.n for r in S.words(frame, every=2, least=1, shortest=1).collect()}
    want = Counter()
    for doc_id, text in corpus():
        for run in re.findall(S.RUN, text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1:] if h % 2 == 0 else run] += 1
    want.pop("", None)
    assert got == dict(want)


def test_empty_tables(spark, frame):
    assert S.variants(frame.limit(0)).collect() == []
    assert S.variants(spark.createDataFrame([(1, "a few short ones")], "doc_id long, text string")).collect() == []


def test_pairs_in_small_steps(monkeypatch):
    rng = random.Random(3)
    names = sorted({"".join(rng.choice("abc") for _ in range(6)) for _ in range(200)})
    longer = sorted({"".join(rng.choice("abc") for _ in range(7)) for _ in range(200)})
    monkeypatch.setattr(S, "_CELLS", 700)
    monkeypatch.setattr(S, "_COMPARED", 50)
    left, right = (S._spelled([w.encode() for w in ws]) for ws in (names, longer))
    assert set(zip(*(x.tolist() for x in S.near_pairs(left, right)))) == {(i, j) for i, a in enumerate(names) for j, b in enumerate(longer) if near(a, b)}
    assert set(zip(*(x.tolist() for x in S.near_pairs(left, left, True)))) == {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if i < j and near(a, b)}
