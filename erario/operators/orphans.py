"""References to records that don't exist, or didn't stand at the time of the reference.

Parent keys become integers, are sorted and compressed into contiguous runs. Each reference is matched to the run that
starts last at or before it (as-of); beyond the end of that run there is no such parent and the reference is reported
without a look at the parents. Only references within a run go on to the spans in which their parent stood. Runs of
keys that are numbered one after the other are few, so they are held in every task; more than HELD of them are
walked along the sorted keys (``ranges.last_before``). Keys that aren't numbers become hashes, whose runs have length 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erario.operators.ranges import last_before, matching_groups
from erario.session import shuffle_width, written

#: Runs that are handed to every task; 24 bytes each.
HELD = 1_000_000
#: Factor that sets the year ahead of the number in a composite key.
YEAR_STEP = 10**13
_FOREVER = 2**62


def composite_number(year: Column, key: Column) -> Column:
    """Integer for (year, key): whole numbers below 10**13 keep their distance within a year, other texts are hashed."""
    plain = key.rlike(r"^[0-9]{1,13}$")
    return F.when(plain & year.between(0, 99999), year.cast("bigint") * YEAR_STEP + F.when(plain, key).try_cast("bigint")).otherwise(F.xxhash64(year, key))


def runs(parents: DataFrame, group: str, number: str) -> DataFrame:
    """(group, inicio, fim): maximal runs of consecutive numbers; one that a range boundary cuts comes in two pieces."""
    n = shuffle_width(parents.sparkSession)
    keys = parents.select(group, number).filter(F.col(number).isNotNull()).distinct().repartitionByRange(n, group, number).sortWithinPartitions(group, number)

    def compress(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_run = None  # (group, start, end)
        for pdf in batches:
            if not len(pdf):
                continue
            g, k = pdf[group].to_numpy(), pdf[number].to_numpy()
            new = np.ones(len(k), dtype=bool)
            new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1] + 1)
            if open_run and open_run[0] == g[0] and k[0] == open_run[2] + 1:
                new[0] = False
            at = np.flatnonzero(new)
            ends = np.append(at[1:] - 1, len(k) - 1) if len(at) else np.array([], dtype=int)
            out = []
            if open_run:
                upto = (at[0] if len(at) else len(k)) - 1
                open_run = (open_run[0], open_run[1], k[upto] if upto >= 0 else open_run[2])
                if len(at):
                    out.append(open_run)
            if len(at):
                got = list(zip(g[at], k[at], k[ends]))
                out += got[:-1]
                open_run = got[-1]
            if out:
                yield pd.DataFrame(out, columns=[group, "inicio", "fim"])
        if open_run:
            yield pd.DataFrame([open_run], columns=[group, "inicio", "fim"])

    return keys.mapInPandas(compress, f"{group} {keys.schema[group].dataType.simpleString()}, inicio bigint, fim bigint")


def micros(c: Column) -> Column:
    """Microseconds of a timestamp with or without zone (session zone UTC)."""
    return F.unix_micros(c.cast("timestamp"))


def within_runs(asked: DataFrame, runs: DataFrame, held: int = HELD) -> DataFrame:
    """``asked`` (grupo, numero, …) with ``dentro``: whether the run that starts last at or before the number reaches it.

    runs: (grupo, inicio, fim), without overlap; numbers ahead of all runs are in none. A column dentro is replaced.
    """
    asked = asked.drop("dentro")
    few = runs.limit(held + 1).count() <= held
    if few:
        by_group = {g: x.sort_values("inicio") for g, x in runs.toPandas().groupby("grupo")}  # at most ``held`` rows
        shared = asked.sparkSession.sparkContext.broadcast({g: (x["inicio"].to_numpy(), x["fim"].to_numpy()) for g, x in by_group.items()})

        @F.pandas_udf("boolean")
        def reached(group: pd.Series, number: pd.Series) -> pd.Series:
            out = np.zeros(len(number), bool)
            for g in group.unique():
                if g in shared.value:
                    start, end = shared.value[g]
                    mine = (group == g).to_numpy()
                    n = number.to_numpy()[mine]
                    at = np.searchsorted(start, n, "right") - 1
                    out[mine] = (at >= 0) & (n <= end[np.maximum(at, 0)])
            return pd.Series(out)

        return asked.withColumn("dentro", reached("grupo", "numero"))
    none = F.lit(None).cast("bigint")
    rest = F.struct(*[c for c in asked.columns if c not in ("grupo", "numero")])
    line = runs.select("grupo", F.col("inicio").alias("numero"), F.lit(0).alias("tipo"), F.col("fim").alias("fim"), F.lit(None).cast(asked.select(rest.alias("r")).schema["r"].dataType).alias("r"))
    line = line.unionByName(asked.select("grupo", "numero", F.lit(1).alias("tipo"), none.alias("fim"), rest.alias("r")))
    walked = last_before(line, ["grupo"], ["numero", "tipo"], {"fim": (1, "last")}).filter("tipo = 1")
    return walked.select("grupo", "numero", "r.*", F.coalesce(F.col("numero") <= F.col("fim"), F.lit(False)).alias("dentro")).select(*asked.columns, "dentro")


def orphans(references: DataFrame, parents: DataFrame, held: int = HELD) -> DataFrame:
    """``references`` without a parent that stood at their time, with ``motivo``: inexistente or fora_do_prazo.

    references: grupo string (which relation), chave string (plain key), numero bigint (key_number or composite_number
    of it), em timestamp, and any other columns. parents: grupo, chave, numero, de timestamp, ate timestamp (null: still
    there). A parent stands from ``de`` on, up to but without ``ate``. Rows with a null grupo, chave or numero refer to
    nothing and are left out. A reference without a time has any parent of its key that still stands; a parent without
    ``de`` has always stood. With no parents all references are orphans; with no references the result is empty.
    Each distinct (grupo, chave, em) is decided once and joined back, heavy ones by broadcast, so repeated
    references cost little.
    """
    ok = "grupo is not null and chave is not null and numero is not null"
    refs = references.drop("motivo").filter(ok)
    # a reference without a time looks at the end of time
    when = F.coalesce(micros(F.col("em")), F.lit(_FOREVER))
    asked = refs.groupBy("grupo", "chave", "numero", when.alias("quando")).agg(F.count("*").alias("n"))
    kept = parents.filter(ok)
    spans = kept.groupBy("grupo", "chave").agg(F.collect_set(F.struct(F.coalesce(micros(F.col("de")), F.lit(-_FOREVER)).alias("de"), F.coalesce(micros(F.col("ate")), F.lit(_FOREVER + 1)).alias("ate"))).alias("spans"))
    lines = written(runs(kept, "grupo", "numero"), "orphan-runs")
    placed = written(within_runs(asked, lines, held), "orphan-asked")
    beyond = placed.filter("not dentro").select("grupo", "chave", "quando", "n", F.lit("inexistente").alias("motivo"))
    near = placed.filter("dentro").join(spans, ["grupo", "chave"], "left")
    stood = F.exists("spans", lambda s: (s["de"] <= F.col("quando")) & (s["ate"] > F.col("quando")))
    late = near.filter(~F.coalesce(stood, F.lit(False))).select("grupo", "chave", "quando", "n", F.when(F.col("spans").isNull(), "inexistente").otherwise("fora_do_prazo").alias("motivo"))
    why = beyond.unionByName(late).select("grupo", "chave", F.col("quando").alias("__quando"), "motivo", F.col("n").alias("__n"))
    return matching_groups(refs.withColumn("__quando", when), why, ["grupo", "chave", "__quando"], "__n").drop("__quando", "__n")
