"""Anomaly scores by an isolation forest whose trees are built and applied in parallel."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erario.session import written

#: Trees, rows of a tree, and seed.
TREES, ROWS, SEED = 400, 256, 42
#: Raw score above which a row is flagged where no share is given.
AUTO = 0.5
#: Alerts: greatest change of the mean against the run before.
DRIFT = 0.15


def _c(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def grow(x: np.ndarray, rng: np.random.Generator) -> list[list[float]]:
    """Nodes (feature, cut, left, right, rows) of one random tree; feature -1 marks a leaf."""
    limit = int(np.ceil(np.log2(max(2, len(x)))))
    nodes: list[list[float]] = []

    def node(at: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(at)])
        if depth >= limit or len(at) <= 1:
            return me
        part = x[at]
        lo, hi = part.min(0), part.max(0)
        open_ = np.flatnonzero(hi > lo)
        if not len(open_):
            return me
        f = int(rng.choice(open_))
        cut = float(rng.uniform(lo[f], hi[f]))
        left = part[:, f] < cut
        if not left.any() or left.all():
            return me
        nodes[me][:2] = [f, cut]
        nodes[me][2] = node(at[left], depth + 1)
        nodes[me][3] = node(at[~left], depth + 1)
        return me

    node(np.arange(len(x)), 0)
    return nodes


def path_lengths(x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Depth at which each row ends in a tree, with the mean depth that its leaf's rows would add."""
    at = np.zeros(len(x), int)
    depth = np.zeros(len(x))
    while True:
        f = nodes[at, 0].astype(int)
        inner = f >= 0
        if not inner.any():
            break
        left = x[np.arange(len(x)), np.maximum(f, 0)] < nodes[at, 1]
        at = np.where(inner, np.where(left, nodes[at, 2], nodes[at, 3]).astype(int), at)
        depth += inner
    return depth + np.array([_c(n) for n in nodes[:, 4]])[at]


def train(rows: DataFrame, key: str, features: Sequence[str], trees: int = TREES, seed: int = SEED) -> list[np.ndarray]:
    """The forest: each row joins each tree with the chance that gives a tree about ROWS rows, by a hash of its key.

    So the rows that are shuffled are about trees x ROWS, however large the table; the trees that come back are of
    bounded size. Nulls must be imputed before. An empty table gives no trees.
    """
    n = rows.count()
    if not n:
        return []
    p = min(1.0, ROWS / n)
    cols = list(features)
    schema = T.StructType([T.StructField("tree", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    # a row is in at least one tree with this chance; only such rows reach Python, with the number of their trees to draw
    some = 1.0 - (1.0 - p) ** trees
    many = np.cumsum([0.0, *(exp(lgamma(trees + 1) - lgamma(k + 1) - lgamma(trees - k + 1) + k * log(p) + (trees - k) * log1p(-p)) for k in range(1, trees + 1))]) if p < 1 else None

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[cols].to_numpy(float)
            out_t, out_x = [], []
            for h, v in zip(pdf["__h"].to_numpy(), x):
                rng = np.random.default_rng([seed, int(h) & 0xFFFFFFFFFFFFFFFF])
                mine = np.arange(trees) if many is None else rng.choice(trees, size=min(trees, int(np.searchsorted(many, rng.random() * many[-1], "left"))), replace=False)
                out_t.extend(mine.tolist())
                out_x.extend([v] * len(mine))
            if out_t:
                yield pd.DataFrame({"tree": np.array(out_t, dtype="int32"), "x": [v.tolist() for v in out_x]})

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        x = np.array(sorted(map(tuple, pdf["x"])))  # the order of arrival must not matter
        return pd.DataFrame({"tree": [t], "nodes": [json.dumps(grow(x, np.random.default_rng([seed, t])))]})

    chance = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = rows.filter(chance < F.lit(some)).select(F.xxhash64(F.col(key)).alias("__h"), *[F.col(c).cast("double").alias(c) for c in cols]).mapInPandas(draw, schema)
    got = drawn.groupBy("tree").applyInPandas(build, "tree int, nodes string").orderBy("tree").collect()  # at most `trees` rows
    return [np.array(json.loads(r["nodes"])) for r in got]


def raw_scores(rows: DataFrame, features: Sequence[str], forest: list[np.ndarray], out: str = "bruto") -> DataFrame:
    """``rows`` with the raw score in (0, 1): the shorter the paths, the nearer to 1."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)  # bounded: trees x 2 ROWS nodes
    cols = list(features)
    m = max((int(t[0, 4]) for t in forest), default=1)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[cols].to_numpy(float)
            mean = np.mean([path_lengths(x, t) for t in shared.value], axis=0) if len(x) and shared.value else np.zeros(len(x))
            yield pdf.assign(**{out: np.power(2.0, -mean / max(_c(m), 1e-9))})

    return rows.mapInPandas(score, schema)


def scored(rows: DataFrame, features: Sequence[str], forest: list[np.ndarray], contamination: str | float = "auto") -> DataFrame:
    """``rows`` with score_anomalia in [0, 1] (min-max of the raw score) and flag_anomalia.

    contamination: "auto" flags raw scores above AUTO; a number flags about that share of the rows, the highest.
    """
    raw = written(raw_scores(rows, features, forest), "scores")  # read for the bounds and the result
    if contamination == "auto":
        s = raw.agg(F.min("bruto").alias("__lo"), F.max("bruto").alias("__hi"), F.lit(AUTO).alias("__cut"))
    else:
        s = raw.agg(F.min("bruto").alias("__lo"), F.max("bruto").alias("__hi"), F.percentile_approx("bruto", 1 - float(contamination), 100_000).alias("__cut"))
    r = s.first()
    if r["__lo"] is None:
        return raw.select(*rows.columns, F.lit(0.0).alias("score_anomalia"), F.lit(False).alias("flag_anomalia"))
    spread = r["__hi"] - r["__lo"]
    value = F.lit(0.0) if spread <= 0 else (F.col("bruto") - F.lit(r["__lo"])) / F.lit(spread)
    return raw.select(*rows.columns, value.alias("score_anomalia"), (F.col("bruto") > F.lit(r["__cut"])).alias("flag_anomalia"))


def summary(scores: DataFrame, column: str = "score_anomalia") -> dict[str, float]:
    """Counts and shares above the thresholds, and quantiles; 0.0 where there is no score."""
    cuts = (0.70, 0.80, 0.90, 0.95)
    qs = (0.5, 0.75, 0.9, 0.95, 0.99)
    r = scores.agg(F.count(column).alias("n"), *[F.count_if(F.col(column) >= t).alias(f"n{i}") for i, t in enumerate(cuts)], F.percentile(column, F.array(*[F.lit(q) for q in qs])).alias("q"), F.avg(column).alias("m")).first()
    n = r["n"]
    out = {"n": float(n), "media": r["m"] or 0.0}
    for i, t in enumerate(cuts):
        out[f"acima_{t:.2f}"] = float(r[f"n{i}"])
        out[f"parte_{t:.2f}"] = r[f"n{i}"] / n if n else 0.0
    return out | {f"p{int(q * 100)}": (r["q"][i] if r["q"] else 0.0) for i, q in enumerate(qs)}


def alerts(now: dict[str, float], before: float | None) -> list[str]:
    """What looks wrong in a run; alerts never stop it."""
    out = []
    if now["n"] and now["p50"] == now["p99"]:
        out.append("degenerate scores: p50 = p99")
    if before is not None and abs(now["media"] - before) > DRIFT:
        out.append(f"mean moved from {before:.3f} to {now['media']:.3f}")
    return out
