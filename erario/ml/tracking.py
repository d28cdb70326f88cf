"""Models on disk and the record of their runs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from erario.operators.compaction import read_text, replace_text
from erario.operators.lake import Lake

RUNS = "ml.run_metrics"


def save_forest(spark: SparkSession, path: str, forest: Sequence[np.ndarray], features: Sequence[str], about: dict | None = None) -> None:
    """An isolation forest with the features it was trained on; its size is bounded by its trees."""
    replace_text(spark, path, json.dumps({"kind": "forest", "features": list(features), "about": about or {}, "trees": [t.tolist() for t in forest]}))


def load_forest(spark: SparkSession, path: str) -> tuple[list[np.ndarray], list[str], dict]:
    """(trees, features, about) of ``save_forest``; FileNotFoundError where there is none."""
    b = _bundle(spark, path, "forest")
    return [np.array(t) for t in b["trees"]], b["features"], b["about"]


def save_quantiles(spark: SparkSession, path: str, models: dict[float, dict], features: Sequence[str], about: dict | None = None) -> None:
    """Boosted models by quantile with the features they were trained on."""
    replace_text(spark, path, json.dumps({"kind": "quantiles", "features": list(features), "about": about or {}, "models": {str(q): m for q, m in models.items()}}))


def load_quantiles(spark: SparkSession, path: str) -> tuple[dict[float, dict], list[str], dict]:
    """(models, features, about) of ``save_quantiles``."""
    b = _bundle(spark, path, "quantiles")
    return {float(q): m for q, m in b["models"].items()}, b["features"], b["about"]


def _bundle(spark: SparkSession, path: str, kind: str) -> dict:
    text = read_text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    b = json.loads(text)
    if b.get("kind") != kind:
        raise ValueError(f"{path} holds {b.get('kind')}, not {kind}")
    return b


class Run:
    """One run of a model: what it is given and what it gives, appended to ``ml.run_metrics`` when it ends.

    Used as a context; a run that raises is kept with status falhou. Rows: run_id, modelo, tipo (param, metrica, tag,
    artefato, estado), chave, texto, valor, em.
    """

    def __init__(self, lake: Lake, model: str, run_id: str | None = None):
        self.lake, self.model, self.run_id = lake, model, run_id or uuid.uuid4().hex
        self._rows: list[tuple[str, str, str | None, float | None]] = []

    def params(self, **values) -> None:
        self._rows += [("param", k, str(v), None) for k, v in values.items()]

    def metrics(self, values: dict[str, float]) -> None:
        self._rows += [("metrica", k, None, float(v)) for k, v in values.items()]

    def tags(self, **values) -> None:
        self._rows += [("tag", k, str(v), None) for k, v in values.items()]

    def artifact(self, name: str, path: str) -> None:
        self._rows.append(("artefato", name, path, None))

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, error, trace) -> None:
        self._rows.append(("estado", "fim", "ok" if kind is None else f"falhou: {error}", None))
        rows = [(self.run_id, self.model, *r) for r in self._rows]
        df = self.lake.spark.createDataFrame(rows, "run_id string, modelo string, tipo string, chave string, texto string, valor double")
        self.lake.append_stamped(RUNS, df, "em")


def previous_mean(lake: Lake, table: str, column: str = "score_anomalia") -> float | None:
    """Mean of a score over the table that the run before wrote; null where there is no table or no value."""
    if not lake.exists(table):
        return None
    return lake.read(table).agg(F.avg(column).alias("m")).first()["m"]
