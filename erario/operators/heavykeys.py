"""Per-key results where a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erario.operators.ranges import per_key


def key_profile(df: DataFrame, key: Column, value: Column, order: Sequence[str]) -> DataFrame:
    """(chave, linhas, total, menor, maior) of each key, by ranges of (key, order) that cut heavy keys.

    ``total`` is exact: the value is taken as decimal(18,2). A null key is a group of its own; null values count as rows
    and add nothing, so a key with nulls only has null for total, menor and maior. An empty input gives no rows.
    """
    money = value.cast("decimal(18,2)")
    rows = df.select(key.alias("chave"), money.alias("valor"), *[F.col(o).alias(f"ordem{i}") for i, o in enumerate(order)])
    aggs = {
        "linhas": ("count", F.lit(1)),
        "total": ("sum", F.col("valor")),
        "menor": ("min", F.col("valor")),
        "maior": ("max", F.col("valor")),
    }
    return per_key(rows, "chave", [f"ordem{i}" for i in range(len(order))], aggs)


def heavy_keys(df: DataFrame, key: Column, order: Sequence[str], share: float) -> DataFrame:
    """(chave, linhas): keys with more than ``share`` of all rows of ``df``; rows without a key count in the whole."""
    rows = df.select(key.alias("chave"), *[F.col(o).alias(f"ordem{i}") for i, o in enumerate(order)])
    counts = per_key(rows, "chave", [f"ordem{i}" for i in range(len(order))], {"linhas": ("count", F.lit(1))})
    total = counts.agg(F.sum("linhas").alias("todas"))
    return counts.join(F.broadcast(total), F.col("linhas") > F.lit(share) * F.col("todas")).filter("chave is not null").select("chave", "linhas")
