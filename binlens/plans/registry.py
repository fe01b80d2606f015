"""Registry of named queries: a Spark plan over ``Inputs`` plus its DuckDB oracle text."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from binlens.session import apply_defaults, checkpoint_dir
from binlens.sources.fixtures import Inputs, with_fixtures


@dataclass
class Query:
    name: str
    plan: Callable[[Inputs], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register ``plan(inputs) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn: Callable[[Inputs], DataFrame]):
        REGISTRY[name] = Query(name, fn, with_fixtures(oracle) if oracle else None)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # importing the plan modules fills the registry
    from binlens.plans import bundle, composition, identify, mapping, progress, text  # noqa: F401
    return REGISTRY


def inputs_for(spark: SparkSession, sf_dir: str) -> Inputs:
    """Inputs derived once per scale factor and kept as Parquet in the checkpoint folder."""
    apply_defaults(spark)
    tag = re.sub(r"[^A-Za-z0-9]+", "_", os.path.abspath(sf_dir)).strip("_")
    return Inputs(spark, sf_dir, cache_dir=os.path.join(checkpoint_dir(spark), "inputs", tag))


def spark_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reg = load_all()

    def bind(q: Query):
        return lambda spark, sf_dir: q.plan(inputs_for(spark, sf_dir))

    return {n: bind(q) for n, q in reg.items()}


def oracle_texts() -> dict[str, str]:
    return {n: q.oracle for n, q in load_all().items() if q.oracle}
