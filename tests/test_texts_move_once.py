"""A text is moved as a document; no step after the first join sorts or moves it once per event."""
import pytest

from pulserank.plans import adapters as A, catalog
from pulserank.session import scratch_path

SF = "/root/testdata/sf0.001"
catalog.load()


def _children(node):
    return [node.children().apply(i) for i in range(node.children().size())]


def _joins(node) -> bool:
    return node.nodeName() == "Join" or any(_joins(c) for c in _children(node))


def _carried(node) -> list[str]:
    """Steps that move rows and get a text from below a join."""
    found = [x for c in _children(node) for x in _carried(c)]
    if node.nodeName() in ("Join", "Window", "WindowGroupLimit", "Aggregate", "Sort", "RepartitionByExpression"):
        for child in _children(node):
            names = {child.output().apply(i).name() for i in range(child.output().size())}
            if names & {"text", "body", "content"} and _joins(child):
                found.append(node.nodeName())
    return found


@pytest.mark.parametrize("name", [
    "board_defaults", "classify_topic", "embedding_texts", "snapshot_build", "candidate_join", "classify_domain_join", "preference_terms",
    "snapshot_features", "active_communities", "domain_coverage", "opportunity_records", "good_first_issue",
])
def test_no_step_moves_texts_of_events(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan()
    assert _carried(plan) == []


def test_equal_numbers_and_missing_documents(spark):
    """Documents with one number give every event a row each, and the snapshot the first text; events without a document are no rows."""
    path = scratch_path(spark, "odd")
    spark.sql(
        "SELECT id AS event_id, timestamp'2024-01-05' AS ts, id AS user_id, 'view' AS event_type, 1.5D AS value, '{\"k\": 3}' AS props FROM range(6)"
    ).write.parquet(f"{path}/events.parquet")
    spark.sql("SELECT * FROM VALUES (0L, 'b', 'en'), (0L, ' a ', 'en'), (1L, null, 'fr'), (7L, 'x', 'en') AS t(doc_id, text, lang)").write.parquet(f"{path}/documents.parquet")
    spark.sql("SELECT id AS page_id, concat('http://h/', id) AS url, '<title>t</title>' AS html FROM range(1)").write.parquet(f"{path}/pages.parquet")
    rows = A.opportunities(spark, path)
    assert sorted(r["id"] for r in rows.collect()) == ["0", "0", "1", "4", "4", "5"]
    from pulserank.plans.queries_snapshot import snapshot_build

    kept = {r["id"]: r["text"] for r in snapshot_build(spark, path).collect()}
    assert kept == {"0": "a", "1": "", "5": ""}


def test_archive_lines_move_no_texts_of_events(spark):
    from pulserank.plans.queries_sources import archive_lines

    assert _carried(archive_lines(spark, SF)._jdf.queryExecution().optimizedPlan()) == []


def test_packed_csv_is_read_like_plain(spark):
    from pulserank.sources import files, sinks

    rows = spark.createDataFrame([("1", "a\nb", 'x "y", z'), ("2", "c", "d")], "id string, title string, text string")
    for kind in ("none", "gzip"):
        path = scratch_path(spark, "packed")
        sinks.write_csv(rows.coalesce(1), path, compression=kind)
        found = files.csv_files(spark, path)
        assert len(found) == 1 and found[0].endswith(".csv.gz" if kind == "gzip" else ".csv")
        got = files.raw_csv(spark, path).orderBy("id").collect()
        assert [(r["id"], r["title"], r["text"]) for r in got] == [("1", "a\nb", 'x "y", z'), ("2", "c", "d")]
        assert not any("csv" in r["source"] for r in got)


def test_item_texts_are_landed_once(spark):
    """Files of items hold a text's number; documents with one number give an item a row each, items without a document none."""
    from pulserank.plans.queries_sources import _item_files
    from pulserank.sources import hits

    items, texts = (hits.read_items(spark, path) for path in _item_files(spark, SF))
    docs = A.table(spark, SF, "documents")
    assert texts.count() == docs.count() and {r["text"] for r in items.select("text").distinct().collect()} <= {str(r["doc_id"]) for r in docs.collect()}
    records = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "id string, text string")
    landed = spark.createDataFrame([("1", " x "), ("1", "y"), ("2", None)], "id string, text string")
    assert sorted(map(tuple, hits.with_texts(records, landed).collect())) == [("a", "x"), ("a", "y"), ("b", "")]


def test_stored_rows_are_packed(spark):
    """Rows of one document stand together in the stored tables, so a packed file holds about one text per document."""
    from pulserank.plans import queries_text, snapshot as S

    written, _ = S.build([A.untexted(spark, SF)], A.REFERENCE_TS, A.TOPICS, domains=A.DOMAINS, complete=lambda rows: A.with_text(rows, spark, SF))
    for table in (written, queries_text._rows(spark, SF)):
        assert all(name.endswith(".zstd.parquet") for name in table.inputFiles())


def test_candidates_shuffle_texts_of_their_documents_only(spark):
    """Candidates and their texts are stored tables; neither events nor documents are read again behind them."""
    from pulserank.plans.queries_retrieval import candidates

    assert all("pulserank-found-" in name or "pulserank-texts-" in name for name in candidates(spark, SF).inputFiles())


def test_documents_of_few_rows_are_those_of_all(spark):
    """Rows with equal documents, documents with one number and rows without a document: both ways give the same texts."""
    path = scratch_path(spark, "few")
    spark.sql("SELECT * FROM VALUES (0L, 'b', 'en'), (0L, ' a ', 'en'), (1L, null, 'fr'), (3L, 'x', 'en') AS t(doc_id, text, lang)").write.parquet(f"{path}/documents.parquet")
    rows = spark.createDataFrame([("0", "n", ""), ("4", "m", ""), ("1", "m", ""), ("2", "k", "")], "id string, title string, text string")
    few, every = (A.with_text(rows, spark, path, stored=stored) for stored in (True, False))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, every.collect())) == [("0", "n", "a"), ("1", "m", ""), ("4", "m", "a")]
    texts = spark.read.parquet(*[name for name in few.inputFiles() if "pulserank-texts-" in name])
    assert sorted(r["doc_id"] for r in texts.collect()) == [0, 1]


def test_stage_counts_store_what_the_next_key_compares(spark, monkeypatch):
    """Titles and times are needed to choose a row, not behind it."""
    from pulserank.plans import queries_snapshot as Q

    stored, write = [], Q.materialise
    monkeypatch.setattr(Q, "materialise", lambda df, *args, **options: stored.append(write(df, *args, **options)) or stored[-1])
    rows = {r["stage"]: r["rows"] for r in Q.stage_counts(spark, SF).collect()}
    first = Q.dedup.dedup_source_id(A.untexted(spark, SF))
    assert rows == {"standardised": A.untexted(spark, SF).count(), "after_source_id": first.count(), "after_url": Q.dedup.dedup_url(first).count()}
    assert set(stored[0].columns) == {"source", "id", "url", "score", "num_comments"} and all(n.endswith(".zstd.parquet") for n in stored[0].inputFiles())
