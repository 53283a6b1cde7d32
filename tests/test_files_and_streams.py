"""File sources, sinks and the live feed."""
import json
import os

import pytest
from pyspark.sql import functions as F

from pulserank.operators.shaping import standardize
from pulserank.plans import adapters, reports, snapshot as snapshot_plan
from pulserank.sources import files, sinks
from pulserank.streaming import feed


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_folder(spark, tmp_path):
    put(tmp_path / "hn posts.csv", 'id,title,upvotes\n1,"a ""q""\nb",5\n')
    put(tmp_path / "more.csv", "title,id,source,comments\nx,2,reddit,7\n")
    put(tmp_path / "sub" / "deep.csv", "id,title\n3,z\n")
    rows = {r["id"]: r for r in files.raw_csv(spark, str(tmp_path)).collect()}
    assert set(rows) == {"1", "2"} and rows["1"]["source"] == "hn posts" and rows["1"]["title"] == 'a "q"\nb' and rows["1"]["score"] == 5
    assert rows["2"]["source"] == "reddit" and rows["2"]["num_comments"] == 7
    assert files.raw_csv(spark, str(tmp_path), recursive=True).count() == 3


def test_embedding_lines(spark, tmp_path):
    good = put(tmp_path / "v.jsonl", '\ufeff{"opportunity_id": "a", "embedding": [1, 2]}\n\n{"opportunity_id": "b", "embedding": [3, 4]}\n')
    assert files.embeddings(spark, good, check=2).count() == 2
    with pytest.raises(ValueError):
        files.embeddings(spark, good, check=3)
    with pytest.raises(Exception):
        files.embeddings(spark, put(tmp_path / "bad.jsonl", "{oops\n")).collect()


def test_profiles_and_labels(spark, tmp_path):
    users = [{"user_id": "a", "interests": ["x"]}, {"user_id": "b", "interests": []}]
    assert files.profiles(spark, put(tmp_path / "p.json", json.dumps(users, indent=1))).count() == 2
    assert files.profiles(spark, put(tmp_path / "q.json", json.dumps({"users": users}))).count() == 2
    labels = [{"user_id": " a", "opportunity_id": "o", "interaction": "Engaged"}]
    for name, text in (("l.json", json.dumps(labels)), ("m.json", json.dumps({"interactions": labels})), ("n.jsonl", json.dumps(labels[0]))):
        row = files.label_file(spark, put(tmp_path / name, text)).first()
        assert (row["user_id"], row["relevance_label"]) == ("a", 3)
    with pytest.raises(ValueError):
        files.label_file(spark, "x.txt")


def test_snapshot_build_and_reports(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "a", "wh", "", "http://x.example.com/1", 1, 2, "2024-01-01T00:00:00Z"), ("1", "a", "wh", "", "http://x.example.com/1", 9, 2, "2024-01-09T00:00:00Z")],
        "id string, source string, title string, text string, url string, score int, num_comments int, created_utc string",
    )
    path = str(tmp_path / "snap")
    written, meta = snapshot_plan.build([standardize(raw)], "2024-02-01 00:00:00", adapters.TOPICS, path, strict=True, domains=adapters.DOMAINS)
    row = meta.first()
    assert row["row_counts"]["merged"] == 2 and row["deduplication_count"] == 1 and row["domain_coverage"] == {"developer_tools": 1}
    assert written.first()["age_days"] == 23
    assert files.snapshot(spark, str(tmp_path / "none"), path).count() == 1
    reports.write_reports(written, str(tmp_path / "out"))
    assert set(os.listdir(tmp_path / "out")) == set(reports.reports(written))
    sinks.write_csv(written.withColumn("why", F.array(F.lit("x"))), str(tmp_path / "csv"))
    assert files.candidates(spark, str(tmp_path / "csv"), "csv").first()["why"] == '["x"]'


def event(i, source, url, at):
    return json.dumps({"event_id": str(i), "source": source, "title": "t", "url": url, "score": 1, "num_comments": 0, "domain": "d", "ingested_at": at})


def run(spark, folder, out, delay):
    with feed.FeedCounts(spark) as counts:
        query = feed.append(feed.dedup(feed.read_feed(spark, folder, max_files=1), delay), out, f"{out}-check", fmt="parquet")
        query.awaitTermination()
        return counts.totals()


def test_feed_restarts_without_repeats(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(tmp_path / "in" / "1.json", "\n".join([event(1, "hn", "u1", 1000.5), event(2, "hn", "u1", 1001.0), event(3, "reddit", "u1", 1002.0)]))
    assert run(spark, folder, out, "1 hour") == {"processed": 2, "duplicates": 1, "late": 0, "total": 3}
    put(tmp_path / "in" / "2.json", "\n".join([event(4, "hn", "u1", 1100.0), event(5, "hn", "u2", 20000.0)]))
    run(spark, folder, out, "1 hour")
    assert spark.read.parquet(out).count() == 3
    # The watermark is now past the first events: u1 is new again, a late row is dropped and counted.
    put(tmp_path / "in" / "3.json", "\n".join([event(6, "hn", "u1", 20001.0), event(7, "hn", "u9", 1000.0)]))
    assert run(spark, folder, out, "1 hour")["late"] == 1
    assert spark.read.parquet(out).where("url = 'u1' AND source = 'hn'").count() == 2
    assert spark.read.parquet(out).where("url = 'u9'").count() == 0


def test_counts_outlive_the_progress_a_query_remembers(spark, tmp_path):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    for i in range(6):
        put(tmp_path / "in" / f"{i}.json", "\n".join([event(1, "hn", f"u{i}", 1000.0 + i), event(2, "hn", "u0", 5.0)]))
    got = run(spark, str(tmp_path / "in"), str(tmp_path / "out"), None)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert got == {"processed": 6, "duplicates": 6, "late": 0, "total": 12}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_batch_volume(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (15.0,)], "s double").select(F.timestamp_seconds("s").alias("ingested_at"))
    assert sorted(r["events"] for r in feed.volume(df).collect()) == [1, 2]


def test_counts_of_two_feeds_at_once(spark, tmp_path):
    for name, n in (("a", 3), ("b", 5)):
        for i in range(n):
            put(tmp_path / name / f"{i}.json", event(i, "hn", f"u{i % 2}", 1000.0 + i))
    with feed.FeedCounts(spark) as counts:
        queries = [feed.append(feed.dedup(feed.read_feed(spark, str(tmp_path / n), max_files=1)), str(tmp_path / f"{n}-out"), str(tmp_path / f"{n}-check"), fmt="parquet") for n in "ab"]
        for q in queries:
            q.awaitTermination()
        assert [counts.totals(query=q)["total"] for q in queries] == [3, 5]
        assert [counts.totals(query=q)["duplicates"] for q in queries] == [1, 3]


def test_partial_reports_survive_replays_and_restarts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def by_source(batch):
        return batch.groupBy("source").count()

    def now():
        return {r["source"]: r["count"] for r in feed.merged(spark, out, "source string, count bigint", ["source"], ["count"]).collect()}

    assert now() == {}
    for i in range(4):
        put(tmp_path / "in" / f"{i}.json", "\n".join([event(i, "hn", "u", 1.0), event(i, "reddit" if i % 2 else "hn", "u", 2.0)]))
    feed.accumulate(feed.read_feed(spark, folder, max_files=1), by_source, out, f"{out}-check").awaitTermination()
    assert now() == {"hn": 6, "reddit": 2}
    feed.write_partial(by_source, out)(spark.createDataFrame([("hn",)], "source string"), 2)  # batch 2 again; either attempt counts once
    (tmp_path / "out" / "batch=9" / "attempt=half").mkdir(parents=True)  # an attempt that was not finished
    assert sum(now().values()) in (7, 8)
    put(tmp_path / "in" / "4.json", event(9, "devto", "u", 3.0))
    feed.accumulate(feed.read_feed(spark, folder, max_files=1), by_source, out, f"{out}-check").awaitTermination()
    assert now()["devto"] == 1
    feed.compact(spark, out, f"{out}-whole", "source string, count bigint", ["source"], ["count"])
    before, out = now(), f"{out}-whole"
    assert now() == before
