"""Composite operators over DataFrames: deduplication, merge, versions, as-of and overlap joins, series and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from erario.functions.keys import surrogate_key

#: Estimated bytes up to which a dimension is broadcast by ``lookup``.
BROADCAST_BYTES = 16 << 20


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), columns: Sequence[str] | None = None, tie: bool = True) -> DataFrame:
    """One row for each key: greatest ``order`` (nulls least), ties by a hash of the whole row, so re-runs agree.

    An aggregation with map-side combine, so copies of a hot key are reduced before the shuffle. Null keys are keys.
    columns: the columns wanted besides the keys; only these and ``order`` are read where ``tie`` is off, which is for
    orders that leave no tie but between rows whose wanted columns agree.
    """
    rest = [c for c in df.columns if c not in keys and (columns is None or c in columns)]
    out = [c for c in df.columns if c in keys or c in rest]
    if not rest:
        return df.select(*out).distinct()
    by = [F.col(c) for c in order] + ([F.md5(F.to_json(F.struct(*sorted(df.columns))))] if tie or not order else [])
    best = F.max_by(F.struct(*rest), F.struct(*by))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*[c if c in keys else F.col("__best")[c].alias(c) for c in out])


def align(batch: DataFrame, target: DataFrame) -> DataFrame:
    """``batch`` with the columns and types of ``target``: values that don't fit and absent columns become null."""
    return batch.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.schema.fields])


def evolve(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``target`` with the columns that only ``batch`` has, as nulls."""
    new = [f for f in batch.schema.fields if f.name not in target.columns]
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], marker: str) -> DataFrame:
    """Upsert that replays can't turn back.

    Unmatched rows of either side stay; of a matched pair the source wins if the target has no marker or the source's is
    not older. A source row without a marker loses to a target row that has one. Keys match null-safe; ``source`` must
    hold each key once (see ``dedup``). New columns of ``source`` are added, its values are cast to the target's types.
    """
    t = evolve(target, source)
    s = align(source, t)
    cols = t.columns
    a = t.select(F.struct(*cols).alias("t"), *[F.col(k).alias(f"__t_{k}") for k in keys])
    b = s.select(F.struct(*cols).alias("s"), *[F.col(k).alias(f"__s_{k}") for k in keys])
    on = None
    for k in keys:
        c = F.col(f"__t_{k}").eqNullSafe(F.col(f"__s_{k}"))
        on = c if on is None else on & c
    wins = F.col("t").isNull() | (F.col("s").isNotNull() & (F.col(f"t.{marker}").isNull() | F.coalesce(F.col(f"s.{marker}") >= F.col(f"t.{marker}"), F.lit(False))))
    return a.join(b, on, "full_outer").select(F.when(wins, F.col("s")).otherwise(F.col("t")).alias("r")).select("r.*")


def scd2(versions: DataFrame | None, source: DataFrame, key: str, compared: Sequence[str], now: Column) -> DataFrame:
    """Next state of a versioned dimension: (key, compared, valido_de, valido_ate).

    A key seen first opens a version at ``now``; a change in a compared column (nulls equal) closes the open version and
    opens one; keys missing from ``source`` stay open; an unchanged source changes nothing.
    """
    src = source.select(key, *compared)
    opened = src.select(key, *compared, now.alias("valido_de"), F.lit(None).cast("timestamp").alias("valido_ate"))
    if versions is None:
        return opened
    out = [key, *compared, "valido_de", "valido_ate"]
    past = versions.filter("valido_ate is not null").select(*out)
    cur = versions.filter("valido_ate is null")
    j = cur.select(F.struct(*out).alias("v"), F.col(key).alias("__k")).join(src.select(F.struct(key, *compared).alias("n"), F.col(key).alias("__j")), F.col("__k") == F.col("__j"), "full_outer")
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"v.{c}").eqNullSafe(F.col(f"n.{c}"))
    changed = F.col("v").isNotNull() & F.col("n").isNotNull() & ~same
    kept = F.when(F.col("v").isNotNull(), F.struct(*[F.col(f"v.{c}").alias(c) for c in (key, *compared, "valido_de")], F.when(changed, now).otherwise(F.col("v.valido_ate")).alias("valido_ate")))
    fresh = F.when(F.col("v").isNull() | changed, F.struct(*[F.col(f"n.{c}").alias(c) for c in (key, *compared)], now.alias("valido_de"), F.lit(None).cast("timestamp").alias("valido_ate")))
    rows = j.select(F.explode(F.filter(F.array(kept, fresh), lambda r: r.isNotNull())).alias("r")).select("r.*")
    return past.unionByName(rows.select(*out))


def asof_version(facts: DataFrame, key: str, day: str, versions: DataFrame, version_key: str, start: str, end: str, take: Sequence[str]) -> DataFrame:
    """``facts`` with the columns ``take`` of the version that was valid on ``day``; of the oldest one if none was.

    Valid: start <= day < end by date, an open end is later than any day; two versions of one day make an empty span. Of
    several valid ones the earliest counts. Unknown keys and null keys get nulls, so no fact is lost. The versions of a
    key are gathered into one array (their number is that of one entity's changes), so facts are joined once and neither
    grouped nor sorted; a hot key is split by adaptive execution.
    """
    spans = versions.groupBy(F.col(version_key).alias("__k")).agg(F.sort_array(F.collect_set(F.struct(F.col(start).alias("s"), F.col(end).alias("e"), *take))).alias("__v"))
    d = F.col(day).cast("date")
    joined = facts.drop(*take).join(spans, F.col(key) == F.col("__k"), "left")
    fits = F.filter("__v", lambda v: (v["s"].cast("date") <= d) & (v["e"].isNull() | (d < v["e"].cast("date"))))
    best = F.coalesce(F.get(fits, 0), F.get("__v", 0))
    return joined.withColumn("__best", best).select(*[c for c in facts.columns if c not in take], *[F.col("__best")[c].alias(c) for c in take])


def overlap_sum(periods: DataFrame, keys: Sequence[str], first: str, last: str, spans: DataFrame, start: str, end: str, value: str, out: str) -> DataFrame:
    """``periods`` with the sum of ``value`` over the spans of their keys that touch [first, last]; 0.0 where none does.

    Null bounds of a span are open; both bounds are inclusive. What touches a period is what starts up to its last day
    less what ends before its first one. Starts and ends are added up by key and day, then run along the days, so a key
    with most spans costs a row a day and no span meets a period. Spans that end before they start touch a period only if
    it holds both days; those few are matched one by one.
    """
    s = spans.select(*keys, F.coalesce(F.col(start), F.lit("0001-01-01").cast("date")).alias("__s"), F.col(end).alias("__e"), F.col(value).cast("decimal(18,2)").alias("__x"))
    straight = s.filter(F.col("__e").isNull() | (F.col("__s") <= F.col("__e")))
    p = periods.select(*keys, first, last).distinct()
    none = F.lit(None).cast("decimal(28,2)")
    # on one day what starts comes before the periods that end then, and what ends comes after the periods that start then
    line = (
        straight.groupBy(*keys, F.col("__s").alias("__d")).agg(F.sum("__x").cast("decimal(28,2)").alias("__in")).select(*keys, "__d", F.lit(1).alias("__k"), "__in", none.alias("__out"), F.lit(None).cast("date").alias("__a"))
        .unionByName(straight.filter("__e is not null").groupBy(*keys, F.col("__e").alias("__d")).agg(F.sum("__x").cast("decimal(28,2)").alias("__out")).select(*keys, "__d", F.lit(2).alias("__k"), none.alias("__in"), "__out", F.lit(None).cast("date").alias("__a")))
        .unionByName(p.select(*keys, F.col(last).alias("__d"), F.lit(3).alias("__k"), none.alias("__in"), none.alias("__out"), F.col(first).alias("__a")))
        .unionByName(p.select(*keys, F.col(first).alias("__d"), F.lit(0).alias("__k"), none.alias("__in"), none.alias("__out"), F.col(first).alias("__a")))
    )
    w = Window.partitionBy(*keys).orderBy("__d", "__k").rowsBetween(Window.unboundedPreceding, 0)
    run = line.select(*keys, "__d", "__k", "__a", F.sum("__in").over(w).alias("__in"), F.sum("__out").over(w).alias("__out"))
    begun = run.filter("__k = 3").select(*keys, F.col("__a").alias(first), F.col("__d").alias(last), "__in")
    over = run.filter("__k = 0").select(*keys, F.col("__a").alias(first), "__out").distinct()
    sums = begun.join(over, [*keys, first]).select(*keys, first, last, (F.coalesce("__in", F.lit(0)) - F.coalesce("__out", F.lit(0))).alias("__sum"))
    turned = s.filter(F.col("__s") > F.col("__e"))
    extra = p.join(turned, [*keys]).filter((F.col("__s") <= F.col(last)) & (F.col("__e") >= F.col(first))).groupBy(*keys, first, last).agg(F.sum("__x").alias("__more"))
    total = sums.join(extra, [*keys, first, last], "left").select(*keys, first, last, (F.col("__sum") + F.coalesce("__more", F.lit(0))).cast("double").alias(out))
    return periods.join(total, [*keys, first, last], "left").withColumn(out, F.coalesce(out, F.lit(0.0)))


def lookup(facts: DataFrame, dim: DataFrame, on: Sequence[str] | Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """Left join to a dimension; facts without a match stay.

    The dimension is broadcast if the optimizer's estimate of its size (from the files it is read from) is at most
    ``most`` bytes; no job is run for that. Else adaptive execution decides by the size it meets.
    """
    size = int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return facts.join(F.broadcast(dim) if size <= most else dim, on, "left")


def dimension(values: DataFrame, column: str, key: str) -> DataFrame:
    """(key, column): the distinct non-blank values with their surrogate keys."""
    v = values.filter(F.col(column).isNotNull() & (F.trim(column) != "")).select(column).distinct()
    return v.select(surrogate_key(F.col(column)).alias(key), column)


def calendar(first: str, last: str, spark) -> DataFrame:
    """(sk_tempo, data, ano, trimestre, mes, dia_semana) of all days; Monday is 1."""
    days = spark.sql("select explode(sequence(to_date(:a), to_date(:b))) as data", args={"a": first, "b": last})
    return with_calendar(days)


def with_calendar(days: DataFrame) -> DataFrame:
    """Calendar columns for the distinct non-null dates ``data``."""
    d = days.filter("data is not null").select("data").distinct()
    return d.select(F.md5(F.date_format("data", "yyyy-MM-dd")).alias("sk_tempo"), "data", F.year("data").alias("ano"), F.quarter("data").alias("trimestre"), F.month("data").alias("mes"), (F.weekday("data") + 1).alias("dia_semana"))


def mode_per_group(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, column): the most frequent value of each group, of equals the least one; null values don't count."""
    n = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("__n"))
    return n.groupBy(*keys).agg(F.min_by(column, F.struct(-F.col("__n"), F.col(column))).alias(column))


def top_or_other(df: DataFrame, column: str, n: int, other: str = "OUTROS") -> DataFrame:
    """``df`` with all but the ``n`` most frequent values of ``column`` (ties: least value) and nulls made ``other``."""
    top = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), F.asc(column)).limit(n).select(F.col(column).alias("__top"))
    return df.join(F.broadcast(top), F.col(column) == F.col("__top"), "left").withColumn(column, F.coalesce("__top", F.lit(other))).drop("__top")


def tail_cut(series: DataFrame, order: Sequence[str], count: str, share: float = 0.5) -> DataFrame:
    """A series by period without its trailing run of incomplete periods.

    A period is incomplete if its ``count`` is below ``share`` of the median over all periods. The run at the end is cut,
    but the first period always stays. The series has a row for each period, so it is small by nature.
    """
    limit = series.agg((F.percentile(count, 0.5) * share).alias("__limit"))
    marked = series.crossJoin(F.broadcast(limit)).withColumn("__full", (F.col(count) >= F.col("__limit")).cast("int"))
    back = Window.orderBy(*[F.desc(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    first = Window.orderBy(*[F.asc(o) for o in order])
    kept = marked.withColumn("__seen", F.max("__full").over(back)).withColumn("__first", F.row_number().over(first))
    return kept.filter("__seen = 1 or __first = 1").drop("__limit", "__full", "__seen", "__first")


def histogram(df: DataFrame, column: str, bins: int, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """(faixa, inicio, centro, linhas) of equal bins, the last one closed; values outside and nulls are left out."""
    width = (high - low) / bins
    v = F.round(F.col(column), 6)
    b = F.least(F.floor(F.round((v - low) / width, 6)), F.lit(bins - 1)).cast("int")
    rows = df.filter((v >= low) & (v <= high)).groupBy(b.alias("faixa")).agg(F.count("*").alias("linhas"))
    return rows.select("faixa", F.round(low + F.col("faixa") * width, 6).alias("inicio"), F.round(low + (F.col("faixa") + 0.5) * width, 6).alias("centro"), "linhas")


def min_max(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with ``column`` scaled to [0, 1]; 0 where all values are equal."""
    r = df.agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    scaled = F.when(F.col("__hi") > F.col("__lo"), (F.col(column) - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))).when(F.col(column).isNotNull(), F.lit(0.0))
    return df.crossJoin(F.broadcast(r)).withColumn(out, scaled).drop("__lo", "__hi")


def share(part: Column, whole: Column, digits: int = 3) -> Column:
    """Percentage in double, null where the whole is zero or null."""
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str) -> DataFrame:
    """``df`` with a 0/1 column for each of ``values``; null and other values are 0 everywhere."""
    return df.select("*", *[F.when(F.col(column) == v, 1).otherwise(0).alias(f"{prefix}_{v}") for v in values])


def pinball(actual: Column, predicted: Column, quantile: float) -> Column:
    """Pinball loss of one prediction; null where either is null."""
    d = actual - predicted
    return F.when(d >= 0, d * quantile).when(d < 0, -d * (1 - quantile))
