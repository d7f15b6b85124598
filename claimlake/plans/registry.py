"""Registry of named plans over the driver tables and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimlake.plans.oracle_views import with_views

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is DuckDB SQL over the driver tables; ``views`` names the
    bindings it needs as CTEs.  Plans without an oracle get a rows-only check.
    """
    def deco(fn):
        if name in PLANS:
            raise ValueError(f"duplicate plan {name}")
        PLANS[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle, *views)
        return fn
    return deco
