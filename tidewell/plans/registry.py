"""Query registry: name -> (spark plan builder, oracle SQL or None).

Keys are the operator names of the inventory.  Every builder takes
(spark, sf_dir), reads the given tables through the Layers and returns a
DataFrame whose column names equal the oracle SQL's.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.plans.layers import Layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Layers], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Layers(spark, sf_dir))
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from tidewell.plans import q_ingest, q_features, q_metrics, q_models, q_budget, q_reports, q_fits  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
