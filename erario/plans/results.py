"""Results of queries for callers that want rows: pandas at the edge, kept for a while."""

from __future__ import annotations

import time
from collections.abc import Callable, Hashable
from decimal import Decimal

import pandas as pd
from pyspark.sql import SparkSession

#: Seconds for which a result is kept, and rows that a caller gets at most.
KEPT, MOST = 300.0, 1_000_000


def query(spark: SparkSession, sql: str, args: dict | None = None, most: int = MOST, **frames) -> pd.DataFrame:
    """Rows of a SQL text as pandas, decimals as floats.

    Values go in as parameters (``:name``), so none is quoted into the text. OverflowError beyond ``most`` rows.
    """
    df = spark.sql(sql, args=args or None, **frames)
    out = df.limit(most + 1).toPandas()
    if len(out) > most:
        raise OverflowError(f"more than {most} rows")
    for c in out.columns:
        if out[c].map(lambda v: isinstance(v, Decimal)).any():
            out[c] = out[c].astype(float)
    return out


class Kept:
    """Results by key for ``seconds``; older ones are made again. A result that fails isn't kept."""

    def __init__(self, seconds: float = KEPT, clock: Callable[[], float] = time.monotonic):
        self.seconds, self.clock = seconds, clock
        self._held: dict[Hashable, tuple[float, object]] = {}

    def get(self, key: Hashable, make: Callable[[], object]) -> object:
        now = self.clock()
        if key not in self._held or now - self._held[key][0] >= self.seconds:
            self._held[key] = (now, make())
        return self._held[key][1]

    def clear(self) -> None:
        self._held.clear()
