"""Column expressions over ``array<float|double>`` vectors."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from pulserank.functions.text import col, let


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_distance(a: str | Column, b: str | Column) -> Column:
    gaps = F.zip_with(
        col(a), col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)


def norm(v: str | Column) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def unit(v: str | Column) -> Column:
    """Vector of length one; a zero vector stays as it is."""
    return let(norm(v), lambda length: F.when(
        length > 0, F.transform(col(v), lambda x: x.cast("double") / length)
    ).otherwise(col(v).cast("array<double>")))


def blend(a: str | Column, wa: float | Column, b: str | Column, wb: float | Column) -> Column:
    """Weighted sum of two vectors."""
    left = wa if isinstance(wa, Column) else F.lit(float(wa))
    right = wb if isinstance(wb, Column) else F.lit(float(wb))
    return F.zip_with(col(a), col(b), lambda x, y: left * x.cast("double") + right * y.cast("double"))


def similarity_from_distance(distance: str | Column) -> Column:
    """1 / (1 + distance), negative distances as 0; null stays null."""
    value = col(distance).cast("double")
    return F.when(value.isNotNull(), F.lit(1.0) / (F.lit(1.0) + F.greatest(value, F.lit(0.0))))
