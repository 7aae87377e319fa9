"""Registry of runnable plans over the test tables.

Each plan is ``fn(spark, sf_dir) -> DataFrame`` and may carry the equivalent
ANSI SQL that DuckDB runs as an independent oracle on the same Parquet files.
Plans without SQL are checked rows-only (stated per plan).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}


def plan(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def deco(fn: Plan) -> Plan:
        if name in PLANS:
            raise KeyError(f"duplicate plan {name}")
        PLANS[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module (registration happens on import)."""
    import importlib

    for mod in MODULES:
        importlib.import_module(f"quarry.plans.{mod}")


MODULES = ("core", "window_plans", "quality_plans", "scalar_plans", "similarity_plans",
           "lifecycle_plans", "source_plans")
