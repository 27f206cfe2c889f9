"""All named queries of the event operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import aggregate_queries, asset_queries, cluster_queries, curation_queries, event_queries, post_queries, resolve_queries, row_queries  # noqa: F401  they register their queries
from .registry import QUERIES, SQL
from .row_queries import category_counts as flagship  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
