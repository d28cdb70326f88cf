"""Range partitioning on a composite key, with boundary states stitched between the ranges.

A hash partitioning puts all rows of a key into one task. Sorting rows into ranges of (key, order) instead lets Spark's
sampled quantiles cut a heavy key into as many ranges as its rows need; what a range can't know is only the state that
the ranges before it leave behind. Those states are a row per range, so they are cheap to gather and to hand on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from erario.session import shuffle_width, written


#: Stands for null in carried columns; the least bigint is no value of theirs.
_NONE = -(2**63)


def into_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` in ranges of (keys, order), cut at sampled quantiles, sorted within each range.

    ``order`` should tell the rows of a key apart, else a heavy key can't be cut. Nulls come first.
    """
    n = ranges or shuffle_width(df.sparkSession)
    return df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)


def per_key(df: DataFrame, key: str, order: Sequence[str], aggs: dict[str, tuple[str, Column]], ranges: int | None = None) -> DataFrame:
    """Aggregates of each key, whichever share of the rows it holds: (key, *aggs).

    aggs: name -> (kind, column), kind one of sum, count, min, max. Each range makes partial states of its keys; a key
    that was cut has one in every range it spans, and these few are merged. A null key is a group of its own, as in
    GROUP BY. An empty input gives no rows.

    No sort is needed for these states, so the ranges are only cut, not sorted.
    """
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    part = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    cols = df.select(F.col(key).alias("__key"), *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], *[c.alias(f"__v{i}") for i, (_, c) in enumerate(aggs.values())])
    n = ranges or shuffle_width(df.sparkSession)
    cut = cols.repartitionByRange(n, "__key", *[f"__o{i}" for i in range(len(order))]).withColumn("__range", F.spark_partition_id())
    states = cut.groupBy("__range", "__key").agg(*[part[kind](f"__v{i}").alias(f"__s{i}") for i, (kind, _) in enumerate(aggs.values())])
    out = states.groupBy("__key").agg(*[merge[kind](f"__s{i}").alias(name) for i, (name, (kind, _)) in enumerate(aggs.items())])
    return out.withColumnRenamed("__key", key)


def running(df: DataFrame, key: str, order: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """``df`` with each row's place (``row_in_key``, from 1) and running total (``total_in_key``) within its key.

    Rows of a key are taken in ``order``; nulls in ``value`` add nothing. Columns called row_in_key or total_in_key in
    the input are replaced. The total is a double; give integers or cents where it must be exact.
    """
    df = df.drop("row_in_key", "total_in_key")
    schema = T.StructType([*df.schema.fields, T.StructField("__range", T.IntegerType()), T.StructField("row_in_key", T.LongType()), T.StructField("total_in_key", T.DoubleType())])
    cut = into_ranges(df, [key], order, ranges).withColumn("__range", F.spark_partition_id())

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, n0, t0 = object(), 0, 0.0
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf[key].astype(object).where(pdf[key].notna(), None)
            same = k.iloc[0] == last or (k.iloc[0] is None and last is None)
            # a new run starts where the key differs from the row before
            prev = k.shift(1)
            start = ~((k == prev) | (k.isna() & prev.isna()))
            start.iloc[0] = not same
            run = start.cumsum()
            first = run == 0  # rows that continue the last batch's key
            v = pd.to_numeric(pdf[value], errors="coerce").astype(float).fillna(0.0)
            rows = pdf.groupby(run, sort=False).cumcount() + 1
            totals = v.groupby(run, sort=False).cumsum()
            rows[first] += n0
            totals[first] += t0
            last, n0, t0 = k.iloc[-1], int(rows.iloc[-1]), float(totals.iloc[-1])
            yield pdf.assign(row_in_key=rows.astype("int64"), total_in_key=totals)

    # written, as a second computation would sample other cuts
    local = written(cut.mapInPandas(places, schema), "running")
    states = local.groupBy("__range", key).agg(F.max("row_in_key").alias("__n"), F.max(F.struct("row_in_key", "total_in_key"))["total_in_key"].alias("__t"))
    # only keys that end a range and start the next are carried: a row for each range and cut key
    w = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    several = states.groupBy(key).agg(F.count("*").alias("__ranges")).filter("__ranges > 1").drop("__ranges").withColumnRenamed(key, "__k")
    cut_states = states.join(F.broadcast(several), states[key].eqNullSafe(several["__k"])).drop("__k")  # at most two cut keys a range
    carry = cut_states.select(F.col("__range").alias("__r"), F.col(key).alias("__k"), F.sum("__n").over(w).alias("__n0"), F.sum("__t").over(w).alias("__t0"))
    joined = local.join(F.broadcast(carry), (local["__range"] == carry["__r"]) & local[key].eqNullSafe(carry["__k"]), "left")
    return joined.withColumn("row_in_key", F.col("row_in_key") + F.coalesce("__n0", F.lit(0))).withColumn("total_in_key", F.col("total_in_key") + F.coalesce("__t0", F.lit(0.0))).drop("__range", "__r", "__k", "__n0", "__t0")


def last_before(df: DataFrame, levels: Sequence[str], order: Sequence[str], carried: dict[str, tuple[int, str]], ranges: int | None = None) -> DataFrame:
    """Fill columns forward along a range-partitioned order: the as-of step of a sort-merge over unbounded keys.

    df: rows of both sides of the as-of match. Each column c of ``carried`` (name -> (depth, how)) is bigint and null on
    the rows that only ask. After the call it holds, for each row, the value that the rows up to it (itself included,
    in the order of levels then order) left behind among the rows which are equal in the first ``depth`` levels: the
    last one (how = "last") or the greatest (how = "max"). Rows before the first such value get null.

    Levels must not be null. A level whose rows are a third of the table is cut into ranges like any other.
    """
    names = list(carried)
    # pandas would turn a bigint column with nulls into doubles
    df = df.select(*[F.coalesce(F.col(c), F.lit(_NONE)).alias(c) if c in carried else F.col(c) for c in df.columns])
    n = ranges or shuffle_width(df.sparkSession)
    # kept, as it is read twice and a second computation would sample other cuts; lost blocks get the same cuts again
    # each row carries its range: the number of a task says nothing of it where this is one side of a union
    cut = df.repartitionByRange(n, *levels, *order).sortWithinPartitions(*levels, *order).withColumn("__range", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    depth = {c: d for c, (d, _) in carried.items()}
    how = {c: h for c, (_, h) in carried.items()}
    used = max(depth.values())
    lv = list(levels[:used])
    key_fields = [T.StructField(f"__first{i}", df.schema[k].dataType) for i, k in enumerate(lv)] + [T.StructField(f"__last{i}", df.schema[k].dataType) for i, k in enumerate(lv)]
    state_schema = T.StructType([T.StructField("__range", T.IntegerType()), *key_fields, *[T.StructField(f"__c{i}", T.LongType()) for i in range(len(names))]])

    def runs(pdf: pd.DataFrame, d: int) -> np.ndarray:
        """Number of the run of equal levels that each row is in, from 0."""
        new = np.zeros(len(pdf), dtype=bool)
        for k in lv[:d]:
            v = pdf[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.cumsum(new)

    def filled(pdf: pd.DataFrame, before: dict[str, tuple[tuple, int | None]]) -> tuple[dict[str, np.ndarray], dict[str, tuple[tuple, int | None]]]:
        """Values by column; the states after the last row. before: the states ahead of the first row."""
        out, after = {}, {}
        m = len(pdf)
        first = {d: tuple(pdf[k].iloc[0] for k in lv[:d]) for d in set(depth.values())}
        final = {d: tuple(pdf[k].iloc[-1] for k in lv[:d]) for d in set(depth.values())}
        run = {d: runs(pdf, d) for d in set(depth.values())}
        for c in names:
            d = depth[c]
            v = pdf[c].to_numpy()
            has = v != _NONE
            r = run[d]
            start = np.searchsorted(r, r, "left")
            at = np.maximum.accumulate(np.where(has, np.arange(m), -1))
            ok = at >= start
            if how[c] == "last":
                got = np.where(ok, v[np.maximum(at, 0)], 0)
            else:
                got = pd.Series(v).groupby(r, sort=False).cummax().to_numpy()
            k0, x0 = before.get(c, ((), None))
            if x0 is not None and k0 == first[d]:
                mine = r == 0
                if how[c] == "last":
                    got = np.where(mine & ~ok, x0, got)
                else:
                    got = np.where(mine, np.maximum(got, x0), got)
                ok = ok | mine
            out[c] = np.where(ok, got, _NONE)
            after[c] = (final[d], int(got[-1]) if ok[-1] else None)
        return out, after

    def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row a range: its first and last levels and the state at its end."""
        here, head, tail, carry = 0, None, None, {}
        for pdf in batches:
            if len(pdf):
                here = int(pdf["__range"].iloc[0])
                head = head or tuple(pdf[k].iloc[0] for k in lv)
                tail = tuple(pdf[k].iloc[-1] for k in lv)
                _, carry = filled(pdf, carry)
        if head is not None:
            yield pd.DataFrame([[here, *head, *tail, *[_NONE if carry[c][1] is None else carry[c][1] for c in names]]], columns=[f.name for f in state_schema.fields])

    need = cut.select(*lv, *names, "__range")
    ends = sorted(need.mapInPandas(states, state_schema).collect(), key=lambda r: r["__range"])  # one row a range
    carry: dict[str, tuple[tuple, int | None]] = {}
    ahead: dict[int, dict[str, tuple[tuple, int | None]]] = {}
    for r in ends:
        ahead[r["__range"]] = dict(carry)
        head, tail = tuple(r[f"__first{i}"] for i in range(used)), tuple(r[f"__last{i}"] for i in range(used))
        for i, c in enumerate(names):
            d, x = depth[c], None if r[f"__c{i}"] == _NONE else r[f"__c{i}"]
            k0, x0 = carry.get(c, ((), None))
            if x0 is not None and k0 == head[:d] == tail[:d]:  # the whole range lies in the run that was open
                x = x0 if x is None else max(x, x0) if how[c] == "max" else x
            carry[c] = (tail[:d], x)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for pdf in batches:
            if len(pdf):
                state = ahead.get(int(pdf["__range"].iloc[0]), {}) if state is None else state
                got, state = filled(pdf, state)
                yield pdf.drop(columns="__range").assign(**got)

    walked = cut.mapInPandas(fill, df.schema)
    return walked.select(*[F.nullif(F.col(c), F.lit(_NONE)).alias(c) if c in carried else F.col(c) for c in df.columns])


def matching_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, share: float = 0.001) -> DataFrame:
    """Inner join of rows to one row a group, where a few groups may hold most rows.

    ``size`` is the number of rows of each group, counted over all rows. Groups with more than ``share`` of the sum of
    all sizes are at most 1 / share, so they are broadcast and their rows are never shuffled; the rest are joined by
    a shuffle in which no key is heavy.
    """
    total = groups.agg(F.sum(size).alias("__total"))
    marked = groups.crossJoin(F.broadcast(total)).withColumn("__heavy", F.col(size) > F.lit(share) * F.col("__total")).drop("__total")
    heavy, light = marked.filter("__heavy").drop("__heavy"), marked.filter("not __heavy").drop("__heavy")
    return rows.join(F.broadcast(heavy), list(keys)).unionByName(rows.join(light, list(keys)))
