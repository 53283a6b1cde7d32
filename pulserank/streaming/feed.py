"""The live feed: read, deduplicate, append, measure."""
from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from pulserank.functions.text import clean

EVENT_SCHEMA = (
    "event_id string, source string, title string, url string, score bigint, num_comments bigint, "
    "domain string, ingested_at double"
)


def read_feed(
    spark: SparkSession, path: str, fmt: str = "json", schema: str = EVENT_SCHEMA, max_files: int | None = None, **options: str
) -> DataFrame:
    """A stream over a landing folder; another ``fmt`` with its ``options`` reads a message bus.

    ``ingested_at`` in epoch seconds becomes a time stamp.  ``max_files`` bounds a micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    df = reader.load(path)
    if dict(df.dtypes).get("ingested_at") == "double":
        df = df.withColumn("ingested_at", F.timestamp_micros((F.col("ingested_at") * 1_000_000).cast("bigint")))
    return df


def fingerprint(source: str | Column = "source", url: str | Column = "url") -> Column:
    return F.md5(F.concat(clean(source), F.lit("::"), clean(url)))


def dedup(df: DataFrame, delay: str | None = None, key: Column | None = None, time: str = "ingested_at") -> DataFrame:
    """First event per fingerprint.

    Every fingerprint is remembered for ever; the RocksDB state store keeps them on disk.
    With a ``delay`` the state of a fingerprint is dropped once the watermark passes it,
    so the state is bounded by the event rate; repeats further apart count as new and rows
    later than the watermark are dropped, which :class:`FeedCounts` counts as ``late``.
    """
    marked = df.withColumn("fp", fingerprint() if key is None else key)
    if delay is None:
        return marked.dropDuplicates(["fp"])
    return marked.withWatermark(time, delay).dropDuplicatesWithinWatermark(["fp"])


def volume(df: DataFrame, window: str = "10 seconds", delay: str | None = None, time: str = "ingested_at", *by: str) -> DataFrame:
    """Events per time window (and key). With a ``delay`` windows are closed by the watermark, and rows later than it are dropped and counted as ``late``."""
    marked = df.withWatermark(time, delay) if delay and df.isStreaming else df
    return (
        marked.groupBy(F.window(time, window).alias("w"), *by)
        .agg(F.count("*").alias("events"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "events")
    )


def append(df: DataFrame, path: str, checkpoint: str, fmt: str = "json", available_now: bool = True, every: str = "10 seconds") -> StreamingQuery:
    """Append to a folder exactly once; restarts continue from the checkpoint."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def publish(df: DataFrame, path: str, checkpoint: str, available_now: bool = True, every: str = "10 seconds") -> StreamingQuery:
    """Keep ``path`` at the current rows of a report over a stream: every micro-batch rewrites the (small) result.

    ``df`` aggregates the whole feed, as the reports of ``operators.analytics`` do; its groups are the state.
    """

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = df.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def write_partial(summarise: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """A batch function that stores the summary of a micro-batch in a folder of the batch's number.

    Each attempt writes a folder of its own, complete once it holds ``_SUCCESS``; :func:`merged` counts one complete attempt per batch. So a batch
    that is replayed changes nothing, and readers never see a part of one.
    """
    def write(batch: DataFrame, number: int) -> None:
        summarise(batch).write.parquet(f"{path}/batch={number}/attempt={uuid.uuid4().hex}")

    return write


def accumulate(
    df: DataFrame, summarise: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = True, every: str = "10 seconds",
) -> StreamingQuery:
    """An incremental report: partial results per micro-batch below ``path``, which :func:`merged` adds up.

    No state is kept and no result is rewritten; the work of a batch follows its rows.
    """
    writer = df.writeStream.foreachBatch(write_partial(summarise, path)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def _complete(spark: SparkSession, path: str) -> list[str]:
    """One complete attempt of every batch."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/attempt=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    by_batch: dict[str, str] = {}
    for folder in sorted(status.getPath().getParent().toString() for status in found):
        by_batch.setdefault(folder.rsplit("/", 2)[1], folder)
    return list(by_batch.values())


def merged(spark: SparkSession, path: str, schema: str | StructType, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The report so far: the partial results of all complete batches, added up per key."""
    folders = _complete(spark, path)
    parts = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def compact(spark: SparkSession, path: str, target: str, schema: str | StructType, keys: Sequence[str], sums: Sequence[str]) -> None:
    """The partial results below ``path`` as a single batch below ``target``, for feeds of very many batches."""
    merged(spark, path, schema, keys, sums).write.parquet(f"{target}/batch=0/attempt={uuid.uuid4().hex}")


class FeedCounts(StreamingQueryListener):
    """Rows read, stored, dropped as duplicates and dropped as late, summed over all micro-batches of a feed.

    Use as a context around the start of the query and hand the query to ``totals``, which waits until it has reported its end. The
    sums are kept per query, so several feeds and reports can run at once, and they hold however many batches there are,
    while a query remembers the progress of its last ones only.
    """

    def __init__(self, spark: SparkSession):
        self._streams, self._changed = spark.streams, threading.Condition()
        self._sums: dict[str, list[int]] = {}
        self._ended: set[str] = set()

    def __enter__(self) -> FeedCounts:
        self._streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        sums = self._sums.setdefault(str(event.progress.runId), [0, 0, 0])
        sums[0] += event.progress.numInputRows
        for state in event.progress.stateOperators:
            sums[1] += int(state.customMetrics.get("numDroppedDuplicateRows", 0))
            sums[2] += state.numRowsDroppedByWatermark

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def totals(self, seconds: float = 60, query: StreamingQuery | None = None) -> dict[str, int]:
        """The sums of ``query``; without one, of the only query that has ended."""
        with self._changed:
            if not self._changed.wait_for(lambda: self._ended if query is None else str(query.runId) in self._ended, seconds):
                raise TimeoutError("the feed has not reported its end")
            if query is None and len(self._ended) > 1:
                raise ValueError("several queries have ended; name one")
            run = next(iter(self._ended)) if query is None else str(query.runId)
        read, duplicates, late = self._sums.get(run, (0, 0, 0))
        return {"processed": read - duplicates - late, "duplicates": duplicates, "late": late, "total": read}
