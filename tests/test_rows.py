"""Single-row semantics on hand-made frames."""
import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulserank.functions import constants as K, kernels
from pulserank.functions.text import clean, collapse_lines, word_count
from pulserank.functions.urls import opportunity_id, url_host
from pulserank.operators import classify, dedup, explain, keyword, matching, profiles, ranking, shaping
from pulserank.operators.trending import terms_of
from pulserank.sources import archive


def values(df, column):
    return [r[column] for r in df.collect()]


def one(spark, expression, **row):
    df = spark.createDataFrame([tuple(row.values())], list(row)) if row else spark.range(1)
    return df.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize("url,host", [
    ("https://www.Example.com/a", "example.com"), ("http://user@host:8080/x", "user@host:8080"), ("example.com/x", None),
    ("//cdn.site.org?q", "cdn.site.org"), ("", None), ("  ", None), ("https://www.www.a.b", "www.a.b"), ("http://[bad/x", None),
    ("1x://a.b", None), ("mailto:me@a.b", None),
])
def test_url_host(spark, url, host):
    assert one(spark, url_host(F.lit(url))) == host


@pytest.mark.parametrize("text", [" a\t b\n\n  c\u00a0d \r\n e\u2028f", "", "   ", "\n\n", "x", "a \x0b b", "a\x1f\x1fb"])
def test_collapse_and_words_follow_python(spark, text):
    lines = [" ".join(line.split()) for line in text.splitlines()]
    lines = [line for line in lines if line]
    assert one(spark, collapse_lines(F.lit(text))) == "\n".join(lines)
    assert one(spark, word_count(F.lit(text))) == len(text.split())
    assert one(spark, clean(F.lit(text))) == text.strip()


def test_opportunity_id(spark):
    import hashlib

    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()[:16]
    make = lambda s, i, u, t: one(spark, opportunity_id(*[F.lit(v).cast("string") for v in (s, i, u, t)]))
    assert make("GitHub ", " 7", "u", "t") == "github::7"
    assert make("GitHub", None, "http://a", "t") == "github::" + digest("http://a")
    assert make("", "7", "", "t") == "unknown::" + digest("|t")


@pytest.mark.parametrize("domain,category", [
    ("github.com", "developer_tools"), ("notgithub.com", "developer_tools"), ("gist.GitHub.com", "developer_tools"),
    ("cloud.google.com", "cloud_computing"), ("x.org", "other"), ("", "unknown"), (None, "unknown"),
])
def test_domain_category(spark, domain, category):
    df = spark.createDataFrame([(domain,)], "domain string")
    mapping = spark.createDataFrame([(k, c, i) for i, (k, c) in enumerate(K.DOMAIN_CATEGORIES.items())], "known string, category string, ord int")
    assert values(df.select(classify.domain_category("domain").alias("c")), "c") == [category]
    assert values(classify.domain_category_join(df, mapping), "domain_category") == [category]


def test_topics(spark):
    vocab = {"Web": ["ui", "css"], "Lang": ["c++", "go"], "Data": ["sql", "ui"]}
    df = spark.createDataFrame([("build", ""), ("c++", "go sql"), ("none", "x"), ("CSS ui", "")], "title string, text string")
    assert values(classify.topic_votes(df, vocab), "topic_category") == ["Web", "Lang", "unknown", "Web"]
    text = F.lower(F.concat_ws(" ", "title", "text"))
    found = values(df.select(classify.topic_matches(text, vocab).alias("t")), "t")
    assert found == [[], ["Lang", "Data"], [], ["Web", "Data"]]
    assert one(spark, classify.topic_matches(F.lit("abc übergo go"), {"A": ["c", "abc"], "B": ["go"]})) == ["A", "B"]
    assert one(spark, classify.topic_matches(F.lit("übergo"), {"B": ["go"]})) == []


def test_large_dictionaries(spark):
    phrases = [a + b for a in "abcdefghij" for b in "abcdefghij"]
    df = spark.createDataFrame([("abacadaeaf jj",), ("",), (None,)], "t string")
    many = values(df.select(matching.substring_hits(F.col("t"), phrases).alias("h")), "h")
    few = [[p for p in phrases if p in (t or "")] for t in ("abacadaeaf jj", "", None)]
    assert [m or [] for m in many] == few
    vocab = {"First": phrases, "Second": ["zz"]}
    rows = spark.createDataFrame([("ab", ""), ("zz", "")], "title string, text string")
    assert values(classify.topic_votes(rows, vocab), "topic_category") == ["First", "Second"]


def test_phrase_index_against_search():
    """Places in many texts, with phrases of one byte to many, letters of several bytes and borders."""
    rng = random.Random(8)
    letters = "ab c-é漢+\n"
    phrases = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(400)})
    bordered = [rng.random() < 0.3 for _ in phrases]
    texts = [None, "", "a", *("".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(300)), "ab" * 5000]

    def holds(text, phrase, whole):
        word = re.compile(r"(?<![a-z0-9+#.-])" + re.escape(phrase) + r"(?![a-z0-9+#.-])") if whole else re.compile(re.escape(phrase))
        return bool(word.search(text or ""))

    want = [[i for i, (p, b) in enumerate(zip(phrases, bordered)) if holds(t, p, b)] for t in texts]
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    assert kernels.PhraseIndex(phrases, bordered).places(column).to_pylist() == want
    assert kernels.PhraseIndex(phrases, bordered, {b"ab ": 9, b"a\xc3\xa9": 7}).places(column).to_pylist() == want


def test_word_counts_of_batches(spark, monkeypatch):
    monkeypatch.setattr(kernels, "_PIECE", 40)
    rng = random.Random(9)
    texts = [None, "", " ", "\xa0", *("".join(rng.choice("ab é漢 \t\n\x1f\x85\xa0\u2003\u3000\u1680") for _ in range(rng.randrange(0, 30))) for _ in range(200))]
    assert kernels.word_counts(pa.array(texts, pa.string())).to_pylist() == [len((t or "").split()) for t in texts]


def test_gram_counts_choose_anchors(spark):
    df = spark.createDataFrame([(i, "the cat" if i % 2 else "the dog") for i in range(50)], "id int, t string")
    counts = matching.gram_counts(df, F.col("t"), ["id"])
    assert counts[b"the"] == 50 and counts[b"cat"] == 25
    assert [r.p for r in df.select("id", matching.phrase_places(F.col("t"), ["the cat", "dog"], counts=counts).alias("p")).orderBy("id").limit(2).collect()] == [[1], [0]]


def test_keyword_paths_agree(spark):
    rows = spark.createDataFrame([(str(i), f"title {w}", w) for i, w in enumerate(("spark sql", "rust", "spark", "pandas sql"))], "id string, title string, text string")
    users = spark.createDataFrame([("u", ["spark", "sql"]), ("v", ["pandas"]), ("w", ["nothing"])], "user_id string, terms array<string>")
    pairs = lambda **o: sorted((r["user_id"], r["id"], round(r["profile_match_score"], 9)) for r in keyword.keyword_match(rows, users, 9, **o).collect())
    assert pairs() == pairs(max_profile_bytes=70) == [("u", "0", 1.0), ("u", "2", 0.5), ("u", "3", 0.5), ("v", "3", 1.0)]
    scored = keyword.with_row_scores(rows.union(rows.withColumn("id", F.concat("id", F.lit("x")))))
    assert keyword._best_matches(scored.coalesce(2), users, 1, K.KEYWORD_WEIGHTS, "id").count() <= 2 * 2  # users x n of each task
    best = keyword.keyword_rank(rows, users, 2)
    assert best.groupBy("user_id").count().where("count = 2").count() == 3


def test_standardize_and_aliases(spark):
    df = spark.createDataFrame(
        [("1", "12.7", "5", "2024-01-01T00:00:00Z", " t "), ("2", "abc", None, "bad", "x")], "id string, upvotes string, comments string, created_at string, title string"
    )
    rows = shaping.standardize(df, "stem").orderBy("id").collect()
    assert [(r["source"], r["score"], r["num_comments"], r["title"]) for r in rows] == [("stem", 12, 5, "t"), ("stem", 0, 0, "x")]
    assert rows[1]["created_utc"] is None and rows[0]["domain"] is None
    both = spark.createDataFrame([(1, 2)], "upvotes int, points int")
    assert shaping.rename_aliases(both).columns == ["score"]
    kept = spark.createDataFrame([(1, 2)], "score int, points int")
    assert shaping.rename_aliases(kept).columns == ["score", "points"]


def test_dedup(spark):
    rows = [("1", "a", 1, 0, "u"), ("1", "a", 9, 0, "V"), ("2", "a", 5, 1, "v "), ("3", "a", 5, 2, ""), ("4", "a", 5, 3, "")]
    df = spark.createDataFrame(rows, "id string, source string, score int, num_comments int, url string")
    assert sorted(values(dedup.deduplicate(df), "id")) == ["1", "3", "4"]
    assert sorted(values(dedup.deduplicate(df, "collapse"), "id")) == ["1", "4"]
    again = dedup.deduplicate(dedup.deduplicate(df))
    assert again.count() == 3
    assert "WindowGroupLimit" in again._jdf.queryExecution().executedPlan().toString()


def test_top_n_beyond_the_pruned_size(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")
    got = dedup.top_n(df, ["k"], [F.desc("id")], 1500)
    assert got.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("m")).orderBy("k").collect() == [(0, 1500, 2000), (1, 1500, 2001)]


def test_ranked_rows_alone_are_shuffled(spark):
    """The ids of the best rows travel to the rows; above the limit both sides meet, with the same result."""
    rows = spark.createDataFrame(
        [(str(i), "t", f"apple {i} {'pie' if i % 3 else ''}", "p", "d", "c", "x", 10, i % 5, 1) for i in range(60)],
        "id string, title string, text string, platform string, domain string, domain_category string, topic_category string, score int, num_comments int, age_days int",
    )
    users = spark.createDataFrame([("a", ["pie"]), ("b", ["apple 7", "x"])], "user_id string, terms array<string>")
    best = keyword.keyword_rank(rows, users, 3)
    assert "LeftSemi" in best._jdf.queryExecution().optimizedPlan().toString()
    narrow = best.select("user_id", "id", "rank")
    got = keyword._with_rows(narrow, rows, "id", broadcast_bytes=0)
    assert "LeftSemi" not in got._jdf.queryExecution().optimizedPlan().toString()
    columns = ["user_id", "id", "rank", "title", "text"]
    assert sorted(got.select(columns).collect()) == sorted(best.select(columns).collect()) and got.count() == 6


def test_long_histories_are_sorted_not_compared_with_each_other(spark):
    """The first of the terms that differ only in case stays, in order; no term is searched for in the list of all."""
    history = [{"title": f"{'Term' if i % 2 else 'tERM'} {i // 3 % 4000}", "domain": f"D{i % 7}", "source": None} for i in range(20_000)]
    df = spark.createDataFrame([("u", ["d3", " X "], history)], "user_id string, interests array<string>, engagement_history array<struct<title:string,domain:string,source:string>>")
    got = profiles.profile_terms(df)
    want = {}
    for term in ["d3", "X", *(v for e in history for v in (e["title"], e["domain"]))]:
        want.setdefault(term.lower(), term)
    assert got.first().terms == list(want.values())
    assert "array_position" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_profiles_read_their_rows_once(spark):
    """The opportunities are counted into stored entries; none of the four fields joins them anew."""
    from pulserank.plans import adapters

    plan = adapters.profiles(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "event_id" not in plan and "page_id" not in plan and "doc_id" not in plan, plan


def test_profile_terms(spark):
    profile = {
        "user_id": "u", "interests": ["RAG", "Spark", ""], "skills": [["python", "rag"], ["SQL"]], "expertise": "Kafka",
        "engagement_history": [{"title": f"t{i}", "domain": "D", "source": None} for i in range(21)], "profile_text": "one, two rag",
    }
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(profile)]))
    row = profiles.profile_terms(df).first()
    assert row["terms"] == ["RAG", "Spark", "python", "SQL", "Kafka", "t0", "D"] + [f"t{i}" for i in range(1, 21)] + ["one", "two"]
    assert row["encoding_text"].split("\n")[0] == "RAG"


def test_reasons(spark):
    base = dict(similarity=0.505, engagement_score=0.0, freshness_score=0.001, trend_score=0.0, effort_score=0.3, days_old=400, topic_category="a_b", domain_category="other", domain="x.y")
    df = spark.createDataFrame([tuple(base.values())], list(base))
    assert explain.with_reasons(df).first()["why"] == ["matches your interest in a b", "50% semantic match", "higher effort to engage"]
    strong = base | dict(similarity=0.9, engagement_score=0.9, freshness_score=0.9, trend_score=0.9, effort_score=1.0, days_old=0, topic_category="unknown", domain="nan")
    df = spark.createDataFrame([tuple(strong.values())], list(strong))
    assert explain.with_reasons(df).first()["why"] == ["90% semantic match", "high community engagement", "active in the last 24h"]


def test_features_guard_bad_values(spark):
    df = spark.createDataFrame(
        [("u", "a", -5, 0, None, 0.5, "w " * 301), ("u", "b", 3, 4, "2030-01-01T00:00:00Z", None, "")],
        "user_id string, opportunity_id string, score int, num_comments int, created_utc string, similarity double, text string",
    )
    rows = ranking.features(df, "2024-01-01 00:00:00").orderBy("opportunity_id").collect()
    assert (rows[0]["engagement_score"], rows[0]["days_old"], rows[0]["effort"]) == (0.0, 365, "high")
    assert (rows[1]["days_old"], rows[1]["similarity"], rows[1]["effort_score"]) == (0, 0.0, 1.0)
    single = ranking.minmax(ranking.features(df.where("opportunity_id = 'b'"), "2024-01-01 00:00:00")).first()
    assert single["engagement_score"] == single["freshness_score"] == 0.0


def test_beginner_by_substring(spark):
    df = spark.createDataFrame([("machine_learning", "x"), ("", "Good First Issue"), ("", "no")], "domain string, title string")
    assert values(df.select(shaping.is_beginner(df).alias("b")), "b") == [True, True, False]


def test_good_first_issue_falls_back(spark):
    df = spark.createDataFrame([("a", "reddit"), ("b", "GitHub"), ("c", "hn")], "title string, source string")
    assert values(shaping.good_first_issues(df), "title") == ["b"]
    assert shaping.good_first_issues(df.where("source <> 'GitHub'"), min_rows=5).count() == 2


def test_trending_terms(spark):
    assert one(spark, terms_of(F.lit("The new Spark 4 engine for SQL"), K.ANALYTICS_STOP_WORDS, r"[\p{L}\p{N}_]{2,}")) == [
        "spark", "engine", "sql", "spark engine", "engine sql"]


def test_payload_depth(spark):
    nested = {"a": {"b": {"c": {"d": {"e": {"f": "in", "g": {"h": "out"}}}}}}, "sha": "no", "list": ["x"] * 60, "n": 1}
    events = spark.createDataFrame([(json.dumps(nested),)], "j string").select(F.try_parse_json("j").alias("payload"))
    leaves = archive.payload_strings(events, depth=6, items=50).first()["payload_strings"]
    assert leaves.count("x") == 50 and "in" in leaves and "out" not in leaves and "no" not in leaves
    leaves = archive.payload_strings(events).first()["payload_strings"]
    assert leaves.count("x") == 60 and "in" in leaves and "out" in leaves and "no" not in leaves


def test_archive_lines(spark):
    ok = {"public": True, "id": 1, "type": "WatchEvent", "actor": {"login": "me"}, "repo": {"name": "o/spark"}, "created_at": "2024-01-02T00:00:00Z", "payload": {}}
    bad = [ok | {"public": "true"}, ok | {"actor": {"login": "[Deleted]"}}, ok | {"repo": {"name": "x"}}, ok | {"created_at": "2023-01-01T00:00:00Z"}, ok | {"id": None}, ok | {"type": "Other"}]
    lines = spark.createDataFrame([(json.dumps(e),) for e in [ok, ok] + bad] + [("{broken",), ("",)], "value string")
    rows = archive.archive_events(archive.parse_lines(lines), "2024-01-01 00:00:00", {"Data": ["spark"]}).collect()
    assert [(r["id"], r["title"], r["url"], r["topic"]) for r in rows] == [("1", "Starred o/spark", "https://github.com/o/spark", "Data")]


def test_published_rows(spark):
    """Two rows of a published result list."""
    rows = [
        ("a", 0.5028623550643885, 0.8830205448442005, 0.0038399816597890868, 1.0, 1.0, 191, "unknown", "other", "blog.genesmindsmachines.com"),
        ("b", 0.4899705828685336, 0.9999999999999999, 0.0003391682839969097, 0.7011776764422875, 1.0, 583, "Trending Open-Source", "other", "bloomberg.com"),
    ]
    df = spark.createDataFrame(rows, "user_id string, similarity double, engagement_score double, freshness_score double, trend_score double, "
                               "effort_score double, days_old int, topic_category string, domain_category string, domain string")
    got = {r["user_id"]: r for r in explain.with_reasons(ranking.score(df.withColumn("title", F.lit("")))).collect()}
    assert got["a"]["final_score"] == pytest.approx(0.6034681659967832) and got["b"]["final_score"] == pytest.approx(0.5906554051776685)
    assert got["a"]["why"] == ["high community engagement", "matches your interest in blog.genesmindsmachines.com", "strong recent activity trend"]
    assert got["b"]["why"] == ["high community engagement", "matches your interest in Trending Open-Source", "low effort to engage"]


def test_payloads_of_any_depth(spark):
    """A payload 300 levels deep, next to flat ones; the plan does not grow with the data."""
    deep = '{"a":' * 300 + '"bottom"' + "}" * 300
    rows = ['{"b":"two","a":["one",{"sha":"hidden","z":"three"}],"n":5}', deep, None, '"only"', "[[[]]]", '{"id":"hidden"}']
    df = spark.createDataFrame(list(enumerate(rows)), "k int, j string").select("k", F.try_parse_json("j").alias("payload"))
    plain = archive.payload_strings(df)
    assert [r.payload_strings for r in plain.orderBy("k").collect()] == [["two", "one", "three"], ["bottom"], [], ["only"], [], []]
    assert plain._jdf.queryExecution().toString().count("Project") <= 12
    assert [len(r.payload_strings) for r in archive.payload_strings(df, depth=1).orderBy("k").collect()] == [1, 0, 0, 1, 0, 0]
    assert archive.payload_strings(df, items=1).where("k = 0").first().payload_strings == ["two", "one"]
