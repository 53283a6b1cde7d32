"""Byte-level BPE by recursive queries against the library that the rank files are made for."""
import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pulserank.llm import duck_bpe


def reference():
    with open(duck_bpe.default_path(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def awkward():
    rng = random.Random(3)
    texts = [
        None, "", " ", "  ", "a  b", "a \n b", "\n\n a\n", " x", "x ", "don't I'LL we've", "\x00 nul\x00 \x1c \x85 \xa0x", "漢字 かな🎉 ñandú Ⅷ²",
        "a" * 3000, "ab" * 1500 + "é" * 400, "the the  the", "the the  the", "<|endoftext|>", "x y " * 300_000 + "  end",
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ") for _ in range(2500)), " " * 5000 + "x",
    ]
    letters = " \n\t\r\x0b\x0c\x1c\x85\xa0 　ab1.,'é漢́Ⅷ²🎉-"
    return texts + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(400)]


@pytest.fixture(scope="module")
def rows(spark):
    schema = "doc_id long, text string, ids string, packed int"  # the last two clash with new columns
    return spark.createDataFrame([(i, t, "own", 5) for i, t in enumerate(awkward())], schema).repartition(4)


def test_ids_equal_the_library(rows):
    own = reference()
    found = duck_bpe.encode(rows)
    assert found.columns == ["doc_id", "text", "ids", "packed", "_ids"]
    for r in found.collect():
        assert r._ids == own.encode_ordinary(r.text or ""), repr(r.text)[:80]
        assert r.ids == "own"


def test_decode_returns_the_bytes(rows):
    back = duck_bpe.decode(duck_bpe.encode(rows.drop("ids"))).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)


def test_decode_of_any_ids(spark):
    own, rng = reference(), random.Random(4)
    lists = [None, [], *([rng.randrange(50_256) for _ in range(n)] for n in (1, 2, 7, 300))]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "k int, ids array<int>")
    for r in duck_bpe.decode(frame).collect():
        assert bytes(r.decoded) == own.decode_bytes(lists[r.k] or [])


def test_digests_follow_the_contract(rows):
    own = reference()
    texts = awkward()
    for r in duck_bpe.digests(duck_bpe.round_trip(rows.drop("packed"))).collect():
        ids = own.encode_ordinary(texts[r.doc_id] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_many_contractions_of_one_round_equal_single_ones():
    """Long words take all occurrences of a pair at once; every cut of the threshold gives the same tokens."""
    rng, codec = random.Random(5), duck_bpe.Codec(duck_bpe.default_path(), duck_bpe.default_pattern())
    words = [bytes(rng.choice(b"aabbcest") for _ in range(rng.randrange(2, 50))) for _ in range(500)]
    words = [w for w in dict.fromkeys(words) if w not in codec.ranks]
    one, all_at_once = {}, {}
    codec._collect(one, words, range(len(words)), words, duck_bpe._LEFTMOST)
    codec._collect(all_at_once, words, range(len(words)), words, duck_bpe._ALL_LEAST)
    assert one == all_at_once


def test_empty_table_and_only_nulls(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert duck_bpe.digests(duck_bpe.round_trip(empty)).collect() == []
    nulls = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    assert {(r.n_tokens, r.decoded_sha256) for r in duck_bpe.digests(duck_bpe.round_trip(nulls)).collect()} == {(0, hashlib.sha256(b"").hexdigest())}


def test_caches_stay_small():
    codec = duck_bpe.Codec(duck_bpe.default_path(), duck_bpe.default_pattern(), known=50)
    own = reference()
    for start in range(0, 3000, 300):
        texts = [f"w{i} x{i}y the same" for i in range(start, start + 300)]
        ends, ids = codec.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [own.encode_ordinary(t) for t in texts]
        assert [bytes(b) for b in codec.decode(ends, ids)] == [t.encode() for t in texts]
    assert len(codec.words) <= 50 and max(len(codec.runs), len(codec.chunks)) <= 25
