"""Quarterly payment forecasts: gradient boosting of quantiles, tuned on walk-forward folds, fits in parallel."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.functions.rules import next_quarter

QUANTILES = (0.1, 0.5, 0.9)
FEATURES = ["lag_1", "lag_4", "ativo", "trimestre", "eleicao", "pago"]
#: Rows that a fit reads at most (a panel has a row a body and quarter); beyond, those of least hash of their key.
FIT_ROWS = 200_000


@dataclass(frozen=True)
class Params:
    """Settings of one boosting run."""

    depth: int = 3
    rate: float = 0.1
    trees: int = 80
    leaf: int = 5


#: Candidates that tuning compares.
GRID = [Params(), Params(depth=2), Params(depth=4), Params(rate=0.05, trees=150), Params(rate=0.2, trees=40), Params(leaf=15), Params(depth=4, rate=0.05, trees=120, leaf=10)]


def _split(x: np.ndarray, g: np.ndarray, at: np.ndarray, leaf: int, bins: list[np.ndarray]) -> tuple[int, float] | None:
    """Cut with the greatest gain in squared sums of the gradient."""
    best, where = 1e-12, None
    total = g[at].sum()
    base = total * total / len(at)
    for f in range(x.shape[1]):
        v = x[at, f]
        for c in bins[f]:
            left = v <= c
            n = int(left.sum())
            if n < leaf or len(at) - n < leaf:
                continue
            s = g[at[left]].sum()
            gain = s * s / n + (total - s) ** 2 / (len(at) - n) - base
            if gain > best:
                best, where = gain, (f, float(c))
    return where


def fit(x: np.ndarray, y: np.ndarray, q: float, p: Params = Params()) -> dict:
    """Boosted trees for quantile ``q``: {"start", "rate", "trees"}; missing features take the median of the column."""
    med = np.array([np.median(c[np.isfinite(c)]) if np.isfinite(c).any() else 0.0 for c in x.T]) if len(x) else np.zeros(x.shape[1])
    x = np.where(np.isfinite(x), x, med)
    bins = [np.unique(np.quantile(c, np.linspace(0.05, 0.95, 16))) if len(c) else np.array([]) for c in x.T]
    start = float(np.quantile(y, q)) if len(y) else 0.0
    pred = np.full(len(y), start)
    trees = []
    for _ in range(p.trees if len(y) >= 2 * p.leaf else 0):
        g = np.where(y > pred, q, q - 1)
        nodes: list[list[float]] = []

        def grow(at: np.ndarray, depth: int, nodes=nodes, g=g, pred=pred) -> int:
            me = len(nodes)
            nodes.append([-1, 0.0, -1, -1, float(np.quantile(y[at] - pred[at], q))])
            cut = _split(x, g, at, p.leaf, bins) if depth < p.depth else None
            if cut:
                left = x[at, cut[0]] <= cut[1]
                nodes[me][:2] = cut
                nodes[me][2] = grow(at[left], depth + 1)
                nodes[me][3] = grow(at[~left], depth + 1)
            return me

        grow(np.arange(len(y)), 0)
        t = np.array(nodes)
        trees.append(nodes)
        pred = pred + p.rate * _apply(x, t)
    return {"start": start, "rate": p.rate, "median": med.tolist(), "trees": trees}


def _apply(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), int)
    while True:
        f = t[at, 0].astype(int)
        inner = f >= 0
        if not inner.any():
            return t[at, 4]
        left = x[np.arange(len(x)), np.maximum(f, 0)] <= t[at, 1]
        at = np.where(inner, np.where(left, t[at, 2], t[at, 3]).astype(int), at)


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Predictions of one model."""
    x = np.where(np.isfinite(x), x, np.array(model["median"]))
    out = np.full(len(x), model["start"])
    for t in model["trees"]:
        out += model["rate"] * _apply(x, np.array(t))
    return out


def ordered(p10, p50, p90) -> tuple:
    """Monotone and not negative."""
    a = np.maximum(p10, 0)
    b = np.maximum(p50, a)
    return a, b, np.maximum(p90, b)


def loss(y: np.ndarray, p: np.ndarray, q: float) -> float:
    """Mean pinball loss."""
    d = y - p
    return float(np.mean(np.maximum(d * q, d * (q - 1)))) if len(y) else float("nan")


def folds(quarters: Sequence[tuple[int, int]], n: int = 4, hold_out: bool = True) -> list[tuple[list[tuple[int, int]], tuple[int, int]]]:
    """(training quarters, test quarter) of the last n quarters, each trained on earlier ones only.

    ``hold_out`` leaves the latest quarter to the final evaluation.
    """
    qs = sorted(set(quarters))
    qs = qs[:-1] if hold_out else qs
    return [(qs[:i], qs[i]) for i in range(max(1, len(qs) - n), len(qs))]


def _panel(panel: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    cols = ["codigo", "ano", "trimestre", *[c for c in FEATURES if c not in ("trimestre",)], "alvo"]
    p = panel.select(*[F.col(c).cast("double").alias(c) if c not in ("codigo", "ano", "trimestre") else F.col(c) for c in cols])
    return p.orderBy(F.xxhash64("codigo", "ano", "trimestre")).limit(limit) if limit else p


def bounded(panel: DataFrame) -> pd.DataFrame:
    """The rows that fits may read, as pandas: at most FIT_ROWS."""
    return _panel(panel).toPandas()


def fit_many(spark: SparkSession, panel: pd.DataFrame, jobs: list[dict]) -> list[dict]:
    """Fit and judge many settings at once, one task for each: jobs hold id, params, quantile, train and test quarters.

    The panel is bounded by FIT_ROWS and broadcast. Returns id, loss on the test quarter and the model as JSON.
    """
    shared = spark.sparkContext.broadcast(panel)
    todo = spark.createDataFrame([(j["id"], json.dumps({**j, "params": asdict(j["params"])})) for j in jobs], "id int, job string")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        j = json.loads(pdf["job"].iloc[0])
        d = shared.value.dropna(subset=["alvo"])
        when = list(zip(d["ano"].tolist(), d["trimestre"].tolist()))
        train_q, test_q = {tuple(x) for x in j["train"]}, {tuple(x) for x in j["test"]}
        a, b = np.array([w in train_q for w in when], bool), np.array([w in test_q for w in when], bool)
        x, y = d[FEATURES].to_numpy(float), d["alvo"].to_numpy(float)
        m = fit(x[a], y[a], j["quantile"], Params(**j["params"]))
        return pd.DataFrame({"id": [j["id"]], "loss": [loss(y[b], predict(m, x[b]), j["quantile"])], "model": [json.dumps(m)]})

    return [r.asDict() for r in todo.groupBy("id").applyInPandas(run, "id int, loss double, model string").collect()]


def tune(spark: SparkSession, panel: pd.DataFrame, grid: Sequence[Params] = GRID, n: int = 4) -> tuple[Params, list[float]]:
    """The candidate of least mean loss over folds and quantiles (the first of equals), and all means."""
    known = panel.dropna(subset=["alvo"])
    fs = folds(list(zip(known["ano"], known["trimestre"])), n)
    jobs = [{"id": i, "params": p, "quantile": q, "train": tr, "test": [te], "of": k} for i, (k, p, (tr, te), q) in enumerate((k, p, f, q) for k, p in enumerate(grid) for f in fs for q in QUANTILES)]
    if not jobs:
        return grid[0], []
    for j in jobs:
        j["train"] = [(int(a), int(b)) for a, b in j["train"]]
        j["test"] = [(int(a), int(b)) for a, b in j["test"]]
    got = {r["id"]: r["loss"] for r in fit_many(spark, panel, jobs)}
    means = [float(np.nanmean([got[j["id"]] for j in jobs if j["of"] == k])) for k in range(len(grid))]
    return grid[int(np.nanargmin(means))], means


def _models(spark: SparkSession, panel: pd.DataFrame, params: Params, quarters: list[tuple[int, int]]) -> list[dict]:
    jobs = [{"id": i, "params": params, "quantile": q, "train": quarters, "test": []} for i, q in enumerate(QUANTILES)]
    return [json.loads(r["model"]) for r in sorted(fit_many(spark, panel, jobs), key=lambda r: r["id"])]


def final_models(spark: SparkSession, panel: pd.DataFrame, params: Params) -> dict[float, dict]:
    """The model of each quantile over all quarters with a known target, to be kept."""
    qs = _quarters(panel)
    return dict(zip(QUANTILES, _models(spark, panel, params, qs))) if qs else {}


def _quarters(panel: pd.DataFrame) -> list[tuple[int, int]]:
    known = panel.dropna(subset=["alvo"])
    return sorted({(int(a), int(b)) for a, b in zip(known["ano"], known["trimestre"])})


def forecasts(spark: SparkSession, panel: DataFrame, params: Params | None = None, backtests: int = 2) -> DataFrame:
    """(codigo, ano_previsto, trimestre_previsto, p10, p50, p90, is_backtest, real) of the next quarter of each body.

    Rows without a known target give forecasts; the last closed quarters give backtests by models that saw earlier
    quarters only. The two never meet in a row. An empty panel gives an empty result.
    """
    pdf = bounded(panel)
    schema = "codigo string, ano_previsto int, trimestre_previsto int, p10 double, p50 double, p90 double, is_backtest boolean, real double"
    qs = _quarters(pdf)
    if not qs:
        return spark.createDataFrame([], schema)
    params = params or tune(spark, pdf)[0]
    sets = [(None, qs)] + [(t, [q for q in qs if q < t]) for t in qs[-backtests:] if any(q < t for q in qs)]
    models = {t: _models(spark, pdf, params, train) for t, train in sets}
    shared = spark.sparkContext.broadcast(models)  # bounded: quantiles x trees
    rows = panel.select("codigo", "ano", "trimestre", *[F.col(c).cast("double").alias(c) for c in FEATURES if c != "trimestre"], F.col("alvo").cast("double").alias("alvo"))

    def run(batches):
        for d in batches:
            when = list(zip(d["ano"].tolist(), d["trimestre"].tolist()))
            x = d[FEATURES].to_numpy(float)
            for t, ms in shared.value.items():
                pick = d["alvo"].isna().to_numpy() if t is None else np.array([w == t for w in when], bool) & d["alvo"].notna().to_numpy()
                if pick.any():
                    a, b, c = ordered(*[predict(m, x[pick]) for m in ms])
                    s = d[pick]
                    yield pd.DataFrame({"codigo": s["codigo"], "ano": s["ano"], "trimestre": s["trimestre"], "p10": a, "p50": b, "p90": c, "is_backtest": t is not None, "real": s["alvo"]})

    out = rows.mapInPandas(run, "codigo string, ano int, trimestre int, p10 double, p50 double, p90 double, is_backtest boolean, real double")
    y, q = next_quarter(F.col("ano"), F.col("trimestre"))
    return out.select("codigo", y.alias("ano_previsto"), q.alias("trimestre_previsto"), "p10", "p50", "p90", "is_backtest", "real")


def quality(f: DataFrame) -> dict[str, float]:
    """Mean error of the median, coverage of the interval, rows; of the backtests with a known value."""
    r = f.filter("is_backtest and real is not null").agg(F.avg(F.abs(F.col("real") - F.col("p50"))).alias("mae"), F.avg((F.col("real").between(F.col("p10"), F.col("p90"))).cast("int")).alias("cobertura"), F.count("*").alias("n")).first()
    return {"mae": r["mae"] or 0.0, "cobertura": r["cobertura"] or 0.0, "n": float(r["n"])}


def alerts(q: dict[str, float], lag4_share: float, least: float = 0.5, most: float = 0.98) -> list[str]:
    """What looks wrong in a run; alerts never stop it."""
    out = []
    if q["n"] and not least <= q["cobertura"] <= most:
        out.append(f"coverage {q['cobertura']:.2f} outside [{least}, {most}]")
    if lag4_share == 0:
        out.append("no row has a value of the year before")
    return out


def run_metrics(spark: SparkSession, run_id: str, values: dict[str, float]) -> DataFrame:
    """(run_id, chave, valor): the metrics of a run, to append to their table."""
    return spark.createDataFrame([(run_id, k, float(v)) for k, v in sorted(values.items())], "run_id string, chave string, valor double")
