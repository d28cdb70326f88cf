"""Incremental runs: watermarks with lookback, and a stream that merges its batches idempotently."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.operators.lake import Lake
from erario.session import written

#: Days that a run goes back behind the watermark, for late rows.
LOOKBACK_DAYS = 7
#: Start where nothing is known.
FIRST_DATE = "2022-01-10"
TABLE = "audit.marcas"
_SCHEMA = "fonte string, marca string, em timestamp"


def watermark(lake: Lake, source: str) -> str | None:
    """Event date up to which a source was read."""
    if not lake.exists(TABLE):
        return None
    r = lake.read(TABLE).filter(F.col("fonte") == source).agg(F.max_by("marca", "em").alias("m")).first()
    return r["m"]


def advance(lake: Lake, source: str, seen: str | None) -> str | None:
    """Move a watermark to the event date ``seen``; an empty run (None) or an earlier date leaves it."""
    old = watermark(lake, source)
    if seen is None or (old is not None and seen <= old):
        return old
    rows = lake.spark.createDataFrame([(source, seen)], "fonte string, marca string").withColumn("em", F.current_timestamp())
    lake.merge(TABLE, rows, ["fonte"], "em")
    return seen


def start_date(marks: Sequence[str | None], fallback: str | None = None, days: int = LOOKBACK_DAYS) -> str:
    """First date of the next run: the oldest of the marks less the lookback.

    Sources that are read together share the oldest mark. Without a mark the fallback holds, then FIRST_DATE; a mark that
    is no date is passed on as it is.
    """
    known = [m for m in marks if m]
    if len(known) < len(marks) or not known:
        mark = fallback
    else:
        mark = min(known)
    if not mark:
        return FIRST_DATE
    try:
        return (date.fromisoformat(mark[:10]) - timedelta(days=days)).isoformat()
    except ValueError:
        return mark


def merge_stream(stream: DataFrame, lake: Lake, name: str, keys: Sequence[str], marker: str, checkpoint: str, conform: Callable[[DataFrame, int], DataFrame] | None = None):
    """Start a stream whose micro-batches are merged into a table until the input is used up; returns the query.

    A batch that is replayed after a failure changes nothing, as the merge is idempotent and order-safe.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        rows = conform(batch, epoch) if conform else batch
        if not rows.isEmpty():
            lake.merge(name, rows, keys, marker)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, stamp: str, key: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Tumbling counts by key with a bound on late rows (an extension: the batch queries use calendar buckets)."""
    return stream.withWatermark(stamp, late).groupBy(F.window(stamp, width), key).agg(F.count("*").alias("n"))


def chain(spark: SparkSession, steps: Sequence[tuple[str, Callable[[], object]]]) -> list[str]:
    """Run layers one after the other; a step that raises stops the rest. Returns the names of the steps that ended."""
    done = []
    for name, step in steps:
        step()
        done.append(name)
    return done


def collect(lake: Lake, source: str, read: Callable[[str | None], DataFrame], target: str, stamp: str = "timestamp_evento") -> int:
    """Append what a collector reads since its last success; returns the rows.

    The state of each source is the latest ``stamp`` that was stored, kept only after the append: a run that fails leaves
    the interval to the next one. A run without rows leaves the state. Rows of the state's own instant are read again
    and left out if they are stored.
    """
    since = watermark(lake, f"coletor.{source}")
    rows = read(since)
    if since is not None and lake.exists(target):
        known = lake.read(target).filter(F.col(stamp).cast("string") >= since).select(*rows.columns)
        rows = rows.filter(F.col(stamp).cast("string") >= since).exceptAll(known)
    rows = written(rows, "coletado")
    n = lake.append_stamped(target, rows)
    if n:
        advance(lake, f"coletor.{source}", rows.agg(F.max(F.col(stamp).cast("string")).alias("m")).first()["m"])
    return n
