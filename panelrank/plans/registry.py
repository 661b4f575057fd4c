"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables. The oracle SQL runs on DuckDB views of the same Parquet
files. Column names and types are aligned on both sides (D-09): integer
sums are BIGINT, averages of doubles are reported rounded to 9 decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> None:
    # importing the query modules fills REGISTRY
    from panelrank.plans import (  # noqa: F401
        q_windows, q_clean, q_score, q_metrics, q_audit, q_misc, q_models, q_busy,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
