"""Batch reports over a snapshot."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pulserank.functions import constants as K
from pulserank.operators import analytics
from pulserank.operators.shaping import analytics_view
from pulserank.operators.trending import trending
from pulserank.sources.sinks import write_csv


def reports(snapshot: DataFrame, terms: int = 30, stop_words: Sequence[str] = K.ANALYTICS_STOP_WORDS) -> dict[str, DataFrame]:
    """All reports by file name; each reads only the columns it needs."""
    view = analytics_view(snapshot)
    daily = analytics.daily_volume(view)
    return {
        "active_communities": analytics.active_communities(view),
        "opportunity_volume_over_time": daily,
        "weekly_volume_wow": analytics.weekly_wow(daily),
        "category_distribution": analytics.category_distribution(view),
        "domain_distribution": analytics.domain_distribution(view),
        "trending_topics": trending(view, terms, stop_words),
    }


def write_reports(snapshot: DataFrame, folder: str, **options) -> None:
    for name, df in reports(snapshot, **options).items():
        write_csv(df, f"{folder.rstrip('/')}/{name}")
