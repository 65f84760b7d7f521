"""Query registry.

``register(name, sql)`` records a builder ``(spark, sf_dir) -> DataFrame``
together with the DuckDB SQL that must return the same rows.  ``sql=None``
marks an operator that SQL cannot express; its test compares against a brute
force check on a small fixture instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


_QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        _QUERIES[name] = Query(name, fn, sql)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # Import the plan modules for their registrations.
    from textlab.plans import (  # noqa: F401
        q_agreement,
        q_audit,
        q_corpus,
        q_explore,
        q_features,
        q_text,
        q_labels,
        q_models,
        q_report,
        q_rules,
        q_splits,
    )
    return dict(_QUERIES)
