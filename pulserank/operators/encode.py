"""Text encoding with an encoder that the caller supplies."""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from pulserank.functions import constants as K
from pulserank.functions.text import clean, collapse_lines
from pulserank.operators.shaping import embedding_text, informative_domain, with_opportunity_id


def encode(
    df: DataFrame,
    column: str,
    encoder_factory: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]],
    batch_size: int = 64,
    out: str = "embedding",
) -> DataFrame:
    """Add a vector per text.

    ``encoder_factory()`` runs once per task and returns a function from texts to
    vectors, which is called with up to ``batch_size`` texts.  Texts are normalised
    first: one blank between words, no empty lines.
    """

    @F.pandas_udf(ArrayType(FloatType()))
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoder_factory()
        for texts in batches:
            found: list = []
            for start in range(0, len(texts), batch_size):
                found.extend(list(v) for v in encoder(texts.iloc[start : start + batch_size].tolist()))
            yield pd.Series(found, index=texts.index, dtype=object)

    return df.withColumn(out, vectors(collapse_lines(column)))


def opportunity_records(df: DataFrame, encoder_factory, batch_size: int = 64) -> DataFrame:
    """Embedding records of opportunities: id, vector, source, domain."""
    rows = with_opportunity_id(df)
    rows = rows.select(
        "opportunity_id",
        embedding_text(rows).alias("_text"),
        F.lower(clean("source")).alias("source"),
        informative_domain(rows, K.EMPTY_LABELS_FOR_EMBEDDING).alias("domain"),
    )
    return encode(rows, "_text", encoder_factory, batch_size).select("opportunity_id", "embedding", "source", "domain")


def user_records(profiles: DataFrame, encoder_factory, batch_size: int = 64) -> DataFrame:
    """Embedding records of users from :func:`pulserank.operators.profiles.profile_terms`."""
    return encode(profiles, "encoding_text", encoder_factory, batch_size).select(
        clean("user_id").alias("user_id"), "profile_text", "embedding"
    )
