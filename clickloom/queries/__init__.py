"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them) in full; nothing is capped or sampled unless sampling is the
operator itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


_LOADED: list[bool] = []


def _load() -> None:
    # Import for side effects (registration). Order = catalogue order. A flag,
    # not "registry empty": importing one query module first must not hide the rest.
    if _LOADED:
        return
    from clickloom.queries import (  # noqa: F401
        q_sources, q_cleaning, q_sampling, q_interactions, q_profiling, q_features,
        q_sequences, q_ranking, q_drift, q_vectors, q_negatives, q_analysis, q_quality,
        q_sinks, q_lists, q_sketches,
    )
    _LOADED.append(True)


def all_queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
