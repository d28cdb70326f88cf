"""Scheduled runs of the models: train, score, judge, store, record."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.ml import anomaly, forecast, tracking
from erario.operators.lake import Lake

ANOMALY_FEATURES = ["valor", "emergencia", "status_VIGENTE", "status_ENCERRADO", "status_RESCINDIDO"]
SCORES, FORECASTS = "ml.score_anomalia_contrato", "ml.previsao_pagamento_orgao"


def run_anomaly(spark: SparkSession, lake: Lake, features: DataFrame, bundle: str, trees: int = anomaly.TREES, contamination: str | float = 0.05) -> list[str]:
    """Score all contracts and replace the stored scores; returns the alerts, which never stop the run.

    features: id_contrato_origem, ano and ANOMALY_FEATURES. The mean is compared with that of the run before.
    """
    with tracking.Run(lake, "anomalia") as r:
        r.params(trees=trees, rows=anomaly.ROWS, contamination=contamination, features=",".join(ANOMALY_FEATURES))
        keyed = features.withColumn("chave", F.concat_ws("/", "id_contrato_origem", F.col("ano").cast("string")))
        forest = anomaly.train(keyed, "chave", ANOMALY_FEATURES, trees)
        before = tracking.previous_mean(lake, SCORES)
        out = anomaly.scored(keyed, ANOMALY_FEATURES, forest, contamination).select("id_contrato_origem", "ano", "score_anomalia", "flag_anomalia", F.lit(r.run_id).alias("model_version"), F.current_timestamp().alias("scored_at"))
        lake.replace(SCORES, out, ["ano"], "score")
        now = anomaly.summary(lake.read(SCORES))
        said = anomaly.alerts(now, before)
        tracking.save_forest(spark, bundle, forest, ANOMALY_FEATURES, {"run_id": r.run_id})
        r.metrics(now | {"alertas": len(said)})
        r.tags(alertas="; ".join(said) or "nenhum")
        r.artifact("modelo", bundle)
    return said


def run_forecast(spark: SparkSession, lake: Lake, panel: DataFrame, bundle: str, grid: list[forecast.Params] | None = None) -> list[str]:
    """Tune, forecast the next quarter of each body and replace the stored forecasts; returns the alerts."""
    with tracking.Run(lake, "previsao") as r:
        pdf = forecast.bounded(panel)
        best, means = forecast.tune(spark, pdf, grid or forecast.GRID)
        r.params(**vars(best), candidatos=len(means))
        r.metrics({f"perda_{i}": m for i, m in enumerate(means)})
        f = forecast.forecasts(spark, panel, best).withColumns({"model_version": F.lit(r.run_id), "scored_at": F.current_timestamp()})
        lake.replace(FORECASTS, f, (), "forecast")
        stored = lake.read(FORECASTS)
        q = forecast.quality(stored)
        lag4 = panel.agg(F.avg(F.col("lag_4").isNotNull().cast("int")).alias("x")).first()["x"] or 0.0
        said = forecast.alerts(q, lag4)
        tracking.save_quantiles(spark, bundle, forecast.final_models(spark, pdf, best), forecast.FEATURES, {"run_id": r.run_id, "params": json.dumps(vars(best))})
        r.metrics(q | {"lag4": lag4, "alertas": len(said)})
        r.tags(alertas="; ".join(said) or "nenhum")
        r.artifact("modelo", bundle)
    return said
