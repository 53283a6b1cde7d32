"""What the trees add to the base spans of personal data, and redaction row by row."""
import random

from pyspark.sql import functions as F

from pulserank.llm import pii

SCHEMA = "doc_id long, text string"


def spans_of(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows = pii.find_pii(frame).select("doc_id", pii.joined_spans(F.col("spans")).alias("s")).collect()
    return {r.doc_id: r.s for r in rows}


def test_spelled_addresses_among_prose(spark):
    rng = random.Random(2)
    names = ["anna", "omar.k", "li", "jo-b", "r2d2"]
    prose = [f"They looked at the dot on page {i} and went on." if i % 2 else f"we met at noon, a dot in the sky, {rng.choice(names)}" for i in range(120)]
    mails = [f"please write an email to {rng.choice(names)}{i}@host{i % 7}.org soon" for i in range(120)]
    spelled = [f"please write an email to {rng.choice(names)}{i} at host{i % 7} dot org soon" for i in range(12)]
    found = spans_of(spark, prose + mails + spelled)
    hits = [i for i, s in found.items() if "other:" in s]
    assert len([i for i in hits if i >= 240]) >= 10
    assert len([i for i in hits if i < 120]) <= 2


def test_spelled_address_without_digits_or_signs(spark):
    assert "other:" in spans_of(spark, ["my email is reader at example dot org for now"])[0]
    assert "other:" in spans_of(spark, ["first things first\nmy email is reader at example dot org\nfor now", "nothing"])[0]


def test_small_corpus_uses_the_prior(spark):
    found = spans_of(spark, ["please call my phone 1 (555) 234-5678 today", "order number 2345678 was sent", "", None])
    assert "other:" in found[0] and found[1] == found[2] == found[3] == ""


def test_overlaps_by_position(spark):
    rng = random.Random(4)
    spans = [(i % 5 or None, i % 3, rng.random() < 0.4, s, s + rng.randrange(1, 9)) for i in range(300) for s in [rng.randrange(60)]]
    frame = spark.createDataFrame([(d, t, "k", s, e, str(i), "", "", b) for i, (d, t, b, s, e) in enumerate(spans)], "doc_id long, text_hash long, kind string, start int, end int, value string, before string, after string, base boolean")
    for r in pii._marked(frame).collect():
        assert r.hit == any(b and (d, t) == (r.doc_id, r.text_hash) and s < r.end and e > r.start for d, t, b, s, e in spans)


def test_redact_cuts_each_row_at_its_own_spans(spark):
    rows = [(1, "mail me@x.org now"), (1, "you@y.org wrote"), (None, "a@b.cc"), (2, None), (1, "mail me@x.org now")]
    out = sorted((r.doc_id or 0, r.redacted) for r in pii.redact(spark.createDataFrame(rows, SCHEMA)).collect())
    assert out == [(0, "[EMAIL]"), (1, "[EMAIL] wrote"), (1, "mail [EMAIL] now"), (1, "mail [EMAIL] now"), (2, "")]


def test_no_example_is_left_out(spark, monkeypatch):
    """More distinct proposals than the 4,000 that the fit once took."""
    counts, write = {}, pii.materialise

    def counted(df, label):
        out = write(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(pii, "materialise", counted)
    text = F.concat(F.lit("order number "), (F.col("id") + 1_000_000).cast("string"), F.lit(" was sent"))
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert pii.find_pii(docs).count() == 5_000
    assert counts["pii-sample"] == counts["pii-proposals"] + pii.prior(spark).count() >= 5_000
