"""Registered queries, each over whole tables, with check SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, places: int = 4, without: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    return df.select(*[
        F.round(F.col(n), places).alias(n) if t in ("double", "float") and n not in without else F.col(n)
        for n, t in df.dtypes
    ])


def load_all() -> None:
    from arealens.plans.queries import (  # noqa: F401
        access, allocation, networks, places, rasters, reports, sources, summaries, tables,
    )
