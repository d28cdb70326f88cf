"""Declarative data tests, batch validation, reconciliation and the history of warnings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erario.operators.relational import share


@dataclass(frozen=True)
class Check:
    """A test: its name, its severity (error or warn) and the rows that violate it."""

    name: str
    severity: str
    violations: DataFrame


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, linhas): keys that come more than once; keys with a null part don't count."""
    known = df.dropna(subset=list(keys))
    return known.groupBy(*keys).agg(F.count("*").alias("linhas")).filter("linhas > 1")


def accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """(column, linhas): values outside the list; null is accepted."""
    return df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(F.count("*").alias("linhas"))


def related(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value isn't among the parent's; null is no reference."""
    p = parent.select(F.col(parent_column).alias("__p")).filter("__p is not null").distinct()
    return df.filter(F.col(column).isNotNull()).join(p, F.col(column) == F.col("__p"), "left_anti")


def at_least(df: DataFrame, column: Column, least: float) -> DataFrame:
    """Rows below ``least``; null passes."""
    return df.filter(column < F.lit(least))


def run(checks: Sequence[Check]) -> DataFrame:
    """(teste, severidade, violacoes) of each test in one plan."""
    out: DataFrame | None = None
    for c in checks:
        one = c.violations.agg(F.count("*").alias("violacoes")).select(F.lit(c.name).alias("teste"), F.lit(c.severity).alias("severidade"), "violacoes")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no checks")
    return out


class FailedCheck(RuntimeError):
    """A test of severity error has violations."""


def enforce(checks: Sequence[Check]) -> list[tuple[str, int]]:
    """Runs the tests, raises FailedCheck on the first error with violations, returns the warnings (name, violations)."""
    rows = run(checks).collect()  # one row for each test
    bad = [r for r in rows if r["severidade"] == "error" and r["violacoes"]]
    if bad:
        raise FailedCheck(", ".join(f"{r['teste']}: {r['violacoes']}" for r in bad))
    return [(r["teste"], r["violacoes"]) for r in rows if r["violacoes"]]


def warning_history(checks: Sequence[Check], at: Column) -> DataFrame:
    """(teste, violacoes, medido_em): a row for each warning with violations, to append to the history."""
    return run([c for c in checks if c.severity == "warn"]).filter("violacoes > 0").select("teste", "violacoes", at.alias("medido_em"))


class InvalidBatch(RuntimeError):
    """A batch lacks files, rows, columns or required values."""


def validate_batch(df: DataFrame | None, required: Sequence[str], minimum: int, source: str) -> dict[str, int]:
    """{"registros": n} of a batch, after one pass over all its rows.

    Raises InvalidBatch if there are no files, fewer rows than ``minimum``, or a required column that is missing or null
    or blank anywhere. 0 and false are values. An empty batch passes where ``minimum`` is 0, whatever its columns.
    """
    if df is None:
        raise InvalidBatch(f"{source}: no files")
    missing = [c for c in required if c not in df.columns]
    blank = {c: F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")) for c in required if c in df.columns}
    r = df.agg(F.count("*").alias("__n"), *[x.alias(c) for c, x in blank.items()]).first()
    n = r["__n"]
    if n < minimum:
        raise InvalidBatch(f"{source}: {n} rows, at least {minimum} are due")
    if n and missing:
        raise InvalidBatch(f"{source}: without column {', '.join(missing)}")
    bad = [c for c in blank if r[c]]
    if bad:
        raise InvalidBatch(f"{source}: empty values in {', '.join(f'{c} ({r[c]})' for c in bad)}")
    return {"registros": n}


def batch_sample(df: DataFrame, ends: int, middle: int, group: str, order: str, seed: int = 7) -> DataFrame:
    """First and last ``ends`` rows of each group and about ``middle`` of the rest, for a cheap look; counts don't use it."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(group).orderBy(order)
    n = Window.partitionBy(group)
    r = df.withColumn("__r", F.row_number().over(w)).withColumn("__n", F.count("*").over(n)).withColumn("__x", F.rand(seed))
    rest = F.col("__n") - 2 * ends
    return r.filter((F.col("__r") <= ends) | (F.col("__r") > F.col("__n") - ends) | (F.col("__x") * rest < middle)).drop("__r", "__n", "__x")


def reconcile_counts(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, a, b, diferenca, pct): counts of two layers side by side; a side that is missing counts as null."""
    return left.join(right, key, "full_outer").select(key, a, b, (F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))).alias("diferenca"), share(F.col(b), F.col(a)).alias("pct"))
