"""User vectors that move with every feedback event."""
from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from pulserank.functions import constants as K
from pulserank.functions.vectors import unit
from pulserank.operators.feedback import apply_feedback, feedback_steps

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = StructType([StructField("embedding", ArrayType(DoubleType())), StructField("events", LongType())])
_OUT = "user_id string, embedding array<double>, events bigint"


class UserVector(StatefulProcessor):
    """Keeps one unit vector per user; events of a micro-batch apply in order of (ts, event_id)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("vector", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        steps = pd.concat(list(rows)).sort_values(["ts", "event_id"], kind="stable")
        if self._state.exists():
            stored = self._state.get()
            vector, seen = np.asarray(stored[0], dtype=float), int(stored[1])
        else:
            vector, seen = np.asarray(steps["start"].iloc[0], dtype=float), 0
        for own, other, item in zip(steps["own"], steps["other"], steps["item"]):
            vector = apply_feedback(vector, np.asarray(item, dtype=float), own, other)
            seen += 1
        self._state.update((vector.tolist(), seen))
        yield pd.DataFrame({"user_id": [key[0]], "embedding": [vector.tolist()], "events": [seen]})

    def close(self) -> None:
        pass


def vector_state(
    feedback: DataFrame,
    users: DataFrame,
    items: DataFrame,
    weights: Mapping[str, tuple[float, float]] = K.FEEDBACK_WEIGHTS,
    mode: str = "Append",
) -> DataFrame:
    """Updated vector of every user that has feedback in a micro-batch.

    In append mode the rows are a change log: the row with most ``events`` is a user's
    current vector.  Gives the vectors of :func:`pulserank.operators.feedback.fold` as long as the batches
    arrive in time order.  Needs the RocksDB state store.
    """
    feedback.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    steps = feedback_steps(feedback, items.select("opportunity_id", unit("embedding").alias("embedding")), weights)
    start = users.select("user_id", unit("embedding").alias("start"))
    return (
        steps.join(start, "user_id")
        .groupBy("user_id")
        .transformWithStateInPandas(UserVector(), outputStructType=_OUT, outputMode=mode, timeMode="None")
    )
