"""Catalogue of queries for the operators of the engine, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from erario.plans import checked, composed, serve  # noqa: F401  (checked registers its queries in composed)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: serve.run(b) for n, b in serve.BODIES.items()} | composed.QUERIES
SQL: dict[str, str] = {n: serve.sql(b) for n, b in serve.BODIES.items()} | composed.SQL
