"""Upkeep of the stored tables: compaction, retention, expiry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from erario.operators.lake import Lake

#: Seconds for which old versions can be read.
KEEP_SECONDS = 7 * 86_400.0


@dataclass(frozen=True)
class Upkeep:
    """What one table needs: files a partition, the column whose values are compacted apart, stamp and days of retention."""

    table: str
    files: int = 1
    slice_by: str | None = None
    stamp: str | None = None
    days: int | None = None


def run(lake: Lake, tables: list[Upkeep], now: Column | None = None, keep_seconds: float = KEEP_SECONDS) -> dict[str, str]:
    """Retention, compaction and expiry of each table, each tried twice: {table: "ok" or the error}.

    A table that fails doesn't keep the others from theirs; one that doesn't exist is left out.
    """
    out = {}
    for t in tables:
        if not lake.exists(t.table):
            continue
        for _ in range(2):
            try:
                if t.stamp is not None and t.days is not None:
                    lake.retain(t.table, t.stamp, t.days, F.current_timestamp() if now is None else now)
                lake.compact(t.table, t.files, t.slice_by)
                lake.expire(t.table, keep_seconds)
                out[t.table] = "ok"
                break
            except Exception as e:
                out[t.table] = f"{type(e).__name__}: {e}"[:500]
    return out
