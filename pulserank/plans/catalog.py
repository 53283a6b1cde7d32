"""Registered queries: name -> callable of (spark, sf_dir), and their SQL twins.

Each group module adds its pairs with :func:`query`.
"""
from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
GROUPS = ("shaping", "snapshot", "text", "retrieval", "ranking", "evaluation", "feedback", "sources", "streams")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows can be checked."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def load() -> None:
    for group in GROUPS:
        import_module(f"pulserank.plans.queries_{group}")


def r6(c: str | Column, name: str | None = None) -> Column:
    """Rounded to six digits, which both engines agree on."""
    value = F.col(c) if isinstance(c, str) else c
    return F.round(value.cast("double"), 6).alias(name or c)


def listed(c: str | Column, name: str) -> Column:
    """An array of texts as one text."""
    return F.array_join(c, " | ").alias(name)
