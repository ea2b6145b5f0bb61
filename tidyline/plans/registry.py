"""Query registry: name -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # import for side effects (registration)
    from tidyline.plans import (  # noqa: F401
        augment_queries, bayes_queries, detect_queries, join_queries, learn_queries, relabel_queries,
        report_queries, source_queries, split_queries, stream_queries,
        text_queries,
    )
