"""Registry of plans over the driver tables.

A plan is ``fn(spark, sf_dir) -> DataFrame`` plus, where the result is fixed by
the data, the DuckDB SQL text that states the same result (same column
names). Plans without SQL are random or layout-dependent and are checked by
property tests instead.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

PlanFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    key: str
    fn: PlanFn
    sql: str | None
    doc: str


PLANS: dict[str, Plan] = {}


def plan(key: str, sql: str | None = None):
    def deco(fn: PlanFn) -> PlanFn:
        if key in PLANS:
            raise ValueError(f"duplicate plan key {key!r}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)          # executors import the package for Python UDFs
            return fn(spark, sf_dir)

        PLANS[key] = Plan(key, run, sql, (fn.__doc__ or "").strip())
        return fn
    return deco
