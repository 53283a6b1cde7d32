"""Lines that many documents repeat, found with levelled sorted runs of line hashes.

A run is a table of (h1, h2, n_docs, keeper), bucketed and sorted by the two 64-bit hashes of a
line's key. Batches of documents arrive one after another. A batch is merge-joined with each run:
keys in no run are fresh and carry their keeper; keys that some run holds add only their count.
The batch becomes a run of level 0. ``fanout`` runs of a level are merged into one run of the next,
so a key is rewritten once per level and a batch meets few runs. Buckets make both sides of the join
meet without a shuffle of the runs.

Everything is a DataFrame operation. Runs live below ``spark.checkpoint.dir``.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulserank.llm.common import SPACE, column_free, materialise
from pulserank.session import scratch_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYS = ["h1", "h2"]


class LineRuns:
    """The runs of one corpus."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _write(self, df: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, f"lines-level{level}")
        df.write.bucketBy(self.buckets, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            self._compact(level)

    def _compact(self, level: int) -> None:
        """The runs of a level as one of the next level. Dropping an external table keeps its files."""
        names, self.levels[level] = self.levels[level], []
        self._write(_merged([self.spark.table(n) for n in names]), level + 1)
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def add(self, batch: DataFrame) -> None:
        """``batch``: (h1, h2, n_docs, keeper), a row per key. Earlier batches win as keeper."""
        seen = F.lit(False)
        for i, run in enumerate(self.runs()):
            held = run.where("keeper IS NOT NULL").select(*KEYS, F.lit(True).alias(f"held{i}"))
            batch = batch.join(held.hint("merge"), KEYS, "left")
            seen = seen | F.coalesce(f"held{i}", F.lit(False))
        self._write(batch.select(*KEYS, "n_docs", F.when(~seen, F.col("keeper")).alias("keeper")), 0)

    def merged(self) -> DataFrame:
        """(h1, h2, n_docs, keeper) of every key, a row each."""
        return _merged(self.runs())


def _merged(runs: list[DataFrame]) -> DataFrame:
    """Runs merged pair by pair: a full outer merge join, as both sides are bucketed and sorted by the key.

    Not a union and an aggregate: Spark 4.1 takes a union of bucketed tables for partitioned by their buckets and
    leaves out the shuffle, then reads the tables without buckets, so a key can keep several rows.
    """
    rows, *others = runs
    for run in others:
        run = run.select(*KEYS, F.col("n_docs").alias("n2"), F.col("keeper").alias("k2"))
        rows = rows.join(run.hint("merge"), KEYS, "full").select(
            *KEYS, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n_docs"), F.greatest("keeper", "k2").alias("keeper")
        )
    return rows


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lowered."""
    return F.translate(F.btrim(line, F.lit(SPACE)), _UPPER, _LOWER)


def occurrences(docs: DataFrame, doc_id: str, text: str, min_length: int) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2) of the lines whose key has ``min_length`` code points."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = docs.where(F.col(f"`{doc_id}`").isNotNull()).select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("text_hash"), F.posexplode(F.split(body, "\n", -1)).alias("pos", "line")
    )
    key = line_key(F.col("line"))
    # lowering keeps the length, so the filter need not translate
    return lines.where(F.length(F.btrim(F.col("line"), F.lit(SPACE))) >= min_length).select(
        "doc_id", "text_hash", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")
    )


def batches(found: DataFrame, count: int) -> list[DataFrame]:
    """``found`` by ranges of doc_id, largest first, a row (h1, h2, n_docs, keeper) per key and batch."""
    if count > 1:
        cuts = found.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 1000).alias("c")).first().c or []
    else:
        cuts = []
    edges = [None, *sorted(set(cuts), reverse=True), None]
    out = []
    for upper, lower in zip(edges, edges[1:]):
        part = found
        if upper is not None:
            part = part.where(F.col("doc_id") <= upper)
        if lower is not None:
            part = part.where(F.col("doc_id") > lower)
        once = part.groupBy(*KEYS, "doc_id").agg(F.lit(1).alias("one"))
        out.append(once.groupBy(*KEYS).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")))
    return out


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 20, min_docs: int = 3,
    batch_count: int = 4, fanout: int = 3,
) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text``, and columns ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of space and characters 9 to 13, with A-Z lowered. Keys of at
    least ``min_length`` code points in at least ``min_docs`` documents lose all their lines except in
    the largest ``doc_id`` that holds them. Batches are ranges of ``doc_id`` from the largest down, so
    the first batch with a key has its keeper; their number changes no result.

    A null or empty text is one empty line, which is too short to be dropped. Rows of one id are one
    document. Rows without an id stay unchanged and count for no key. Equal rows get equal results. Other columns
    pass; a column called ``n_lines`` or ``n_dropped`` makes the new ones start with an underscore.
    An empty table gives an empty result. Lines differ if their 128-bit hashes do.
    """
    spark = docs.sparkSession
    found = materialise(occurrences(docs, doc_id, text, min_length), "line-occurrences")
    store = LineRuns(spark, fanout=fanout)
    for batch in batches(found, batch_count):
        store.add(batch)
    # a table of its own: joined from there, a line with a third of all rows can be split, or the few keys sent to the rows
    repeated = materialise(store.merged().where(F.col("n_docs") >= min_docs).select(*KEYS, "keeper"), "repeated-lines")
    drops = (
        found.join(repeated, KEYS).where(F.col("doc_id") != F.col("keeper"))
        .groupBy(F.col("doc_id").alias("__drop_id"), F.col("text_hash").alias("__drop_hash")).agg(F.collect_list("pos").alias("__drop"))
    )
    n_lines, n_dropped = column_free(docs, "n_lines"), column_free(docs, "n_dropped")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    sides = docs.select(*rest, F.split(body, "\n", -1).alias("__lines"), F.xxhash64(body).alias("__hash"))
    same = (F.col(f"`{doc_id}`") == F.col("__drop_id")) & (F.col("__hash") == F.col("__drop_hash"))
    joined = sides.join(drops.hint("shuffle_hash"), same, "left")
    size = F.size("__lines")
    kept = F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(
        F.transform(F.array_except(F.sequence(F.lit(0), size - 1), "__drop"), lambda p: F.get("__lines", p))
    )
    done = joined.withColumn("__kept", kept)
    columns = [F.array_join("__kept", "\n").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return done.select(
        *columns, size.cast("bigint").alias(n_lines), (size - F.size("__kept")).cast("bigint").alias(n_dropped)
    )
