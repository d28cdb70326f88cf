"""Narrative report: facts to prompt, text from an injected writer, every amount checked against the facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.functions import rules
from erario.plans import gold


def top_anomalies(spark: SparkSession, d: str, n: int = 10) -> DataFrame:
    """The n contracts of highest score with body and creditor."""
    f = gold.scores(spark, d).select("id_contrato_origem", "ano", F.col("score_anomalia").alias("score")).filter("score is not null").join(gold.contracts(spark, d).drop("score_anomalia"), ["id_contrato_origem", "ano"])
    f = f.join(F.broadcast(gold.bodies(spark, d).select("sk_orgao", F.col("nome").alias("orgao"))), "sk_orgao", "left").join(gold.creditors(spark, d).select("sk_credor", F.col("nome").alias("credor")), "sk_credor", "left")
    return f.select("id_contrato_origem", "ano", "score", F.col("valor_contrato").cast("double").alias("valor"), rules.reais(F.col("valor_contrato")).alias("valor_texto"), "orgao", "credor", F.col("flag_emergency").alias("emergencia")).orderBy(F.desc("score"), "id_contrato_origem", "ano").limit(n)


def top_forecasts(spark: SparkSession, d: str, n: int = 10) -> DataFrame:
    """The n largest forecasts that are no backtest."""
    p = gold.forecasts(spark, d).filter("not is_backtest and valor_previsto_p50 is not null")
    return p.select("codigo_orgao", "nome_orgao", F.col("ano_previsto").alias("ano"), F.col("trimestre_previsto").alias("trimestre"), F.col("valor_previsto_p10").alias("p10"), F.col("valor_previsto_p50").alias("p50"), F.col("valor_previsto_p90").alias("p90"), *[rules.reais(F.col(f"valor_previsto_p{q}")).alias(f"p{q}_texto") for q in (10, 50, 90)]).orderBy(F.desc("p50"), "codigo_orgao", "ano", "trimestre").limit(n)


def unsupported(spark: SparkSession, text: str, allowed: list[float]) -> list[float]:
    """Amounts of a text that no allowed value supports, by the column rules."""
    row = spark.createDataFrame([(text, allowed)], "t string, a array<double>")
    return row.select(rules.unsupported(rules.amounts(F.col("t")), F.col("a")).alias("u")).first()["u"]


def prompt(anomalies: list[dict], forecasts: list[dict]) -> str:
    """Facts as text for the writer; numbers stand as they may be quoted."""
    a = [f"- contrato {x['id_contrato_origem']}/{x['ano']}: valor {x['valor_texto']}, score {x['score'] * 100:.0f}%, órgão {x['orgao'] or 'não informado'}, credor {x['credor'] or 'não informado'}, emergencial: {'sim' if x['emergencia'] else 'não'}" for x in anomalies]
    p = [f"- órgão {x['codigo_orgao']} ({x['nome_orgao'] or 'não informado'}), {x['ano']}-T{x['trimestre']}: {x['p10_texto']} / {x['p50_texto']} / {x['p90_texto']}" for x in forecasts]
    return "\n".join(["Contratos com maior score de anomalia:", *(a or ["- nenhum"]), "", "Maiores previsões de pagamento (p10 / p50 / p90):", *(p or ["- nenhuma"]), "", "Escreva um relatório e cite somente os valores acima."])


@dataclass(frozen=True)
class Report:
    """Text of a report and the amounts in it that no fact supports, as numbers and as they are shown."""

    text: str
    prompt: str
    unsupported: list[float]
    shown: list[str]


def run(spark: SparkSession, d: str, write: Callable[[str], str], top_a: int = 10, top_p: int = 10) -> Report:
    """Build the prompt from the top rows (bounded by top_a and top_p), let ``write`` answer and check the amounts."""
    a = [r.asDict() for r in top_anomalies(spark, d, top_a).collect()]
    p = [r.asDict() for r in top_forecasts(spark, d, top_p).collect()]
    q = prompt(a, p)
    text = write(q)
    allowed = [x["valor"] for x in a if x["valor"] is not None] + [x[k] for x in p for k in ("p10", "p50", "p90") if x[k] is not None]
    bad = unsupported(spark, text, allowed)
    shown = [r["t"] for r in spark.createDataFrame([(v,) for v in bad], "v double").select(rules.reais(F.col("v")).alias("t")).collect()]
    return Report(text, q, bad, shown)


def save(report: Report, path: str) -> None:
    """The report as a Markdown file."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(report.text)
        if report.shown:
            f.write("\n\n> Valores sem apoio nos dados: " + ", ".join(report.shown) + "\n")
