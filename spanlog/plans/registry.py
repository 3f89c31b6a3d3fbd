"""Registered queries: one Spark query and (where SQL can say it) one DuckDB twin per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..model import to_output
from ..session import prepare
from .fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
BODY: dict[str, str] = {}  # oracle statements without their views
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, fixtures: tuple[str, ...] = (), headline: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle statement."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return to_output(fn(spark, sf_dir).drop("is_open"))
        run.__name__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name], BODY[name] = with_fixtures(sql, *fixtures), sql.strip()
        if headline:
            HEADLINE.append(name)
        return fn
    return deco
