"""Queries built with the DataFrame API and the library's operators, each with SQL written apart from it.

They cover what the SQL catalogue can't show by itself: that operators with state (stored tables, batches, watermarks,
text readers) give what plain SQL gives over the same tables, and that the constants are those of the model.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erario.functions import rules
from erario.functions.keys import digits, plain_key, plain_number, stripped
from erario.operators import quality
from erario.operators import relational as rel
from erario.operators.lake import Lake
from erario.plans import gold, silver
from erario.plans.composed import QUERIES, _with_day, query
from erario.session import drop_on_exit, shared_dir, written
from erario.sources import batches, relational, telemetry
from erario.streaming import incremental
from erario.tables import table

# Fixed values of the model: least committed sum, coverage of a judged quarter, values kept of a category, rows shown, score shown.
COMMITTED, COVERAGE, KEPT, SHOWN, SCORE = 100_000_000, 0.5, 8, 500, 0.7

_H = "%Y-%m-%d %H:%M:%S"
_SPARK = "yyyy-MM-dd HH:mm:ss"


def _scratch(spark: SparkSession) -> str:
    """A folder of the shared one for what a query stores; it isn't kept."""
    path = f"{shared_dir(spark)}/consulta-{uuid.uuid4().hex}"
    drop_on_exit(spark, path)
    return path


def _body_sums(spark: SparkSession, d: str) -> DataFrame:
    f = gold.contracts(spark, d, {"sk_orgao", "valor_pago", "valor_empenhado"})
    named = f.join(gold.bodies(spark, d, {"sk_orgao", "nome"}), "sk_orgao")
    return named.groupBy("nome").agg(F.sum("valor_pago").cast("decimal(18,2)").alias("pago"), F.sum("valor_empenhado").cast("decimal(18,2)").alias("empenhado"))


def _share_above(spark: SparkSession, d: str, least: float) -> DataFrame:
    sums = _body_sums(spark, d).filter(F.col("empenhado") > F.lit(least))
    return sums.withColumn("pct", rel.share(F.col("pago"), F.col("empenhado"))).orderBy(F.desc_nulls_last("pct"), "nome").limit(5)


_SUMS = "SELECT og.nome, CAST(sum(fc.valor_pago) AS DECIMAL(18,2)) AS pago, CAST(sum(fc.valor_empenhado) AS DECIMAL(18,2)) AS empenhado FROM fc, og WHERE og.sk_orgao = fc.sk_orgao GROUP BY og.nome"


# Q-06, SL-03: share of what bodies with large commitments paid
@query(f"SELECT *, round(100 * CAST(pago AS DOUBLE) / CAST(empenhado AS DOUBLE), 3) AS pct FROM ({_SUMS}) WHERE empenhado > {COMMITTED} ORDER BY pct DESC NULLS LAST, nome LIMIT 5", "fc", "og")
def q06_bodies_share(spark: SparkSession, d: str) -> DataFrame:
    return _share_above(spark, d, COMMITTED)


# SL-03 with a bound that small tables pass
@query(f"SELECT *, round(100 * CAST(pago AS DOUBLE) / CAST(empenhado AS DOUBLE), 3) AS pct FROM ({_SUMS}) WHERE empenhado > 1000000 ORDER BY pct DESC NULLS LAST, nome LIMIT 5", "fc", "og")
def sl03_top_share(spark: SparkSession, d: str) -> DataFrame:
    return _share_above(spark, d, 1_000_000)


def _anomalies(spark: SparkSession, d: str) -> DataFrame:
    f = gold.contracts(spark, d).drop("score_anomalia")
    s = gold.scores(spark, d)
    f = f.join(s, ["id_contrato_origem", "ano"]).filter(F.col("score_anomalia") >= SCORE)
    o = table(spark, d, "dim_orgao").select("sk_orgao", "codigo", "ano", "nome", "sigla", "nome_municipio", "carregado_em")
    o = rel.dedup(o, ["codigo", "ano"], ["carregado_em", "sk_orgao"], tie=False).select("sk_orgao", F.col("nome").alias("nome_orgao"), F.col("sigla").alias("sigla_orgao"), "nome_municipio")
    c = gold.creditors(spark, d).select("sk_credor", F.col("nome").alias("nome_credor"), "cnpj_cpf", F.col("tipo").alias("tipo_credor"), "historico_infringement")
    t = gold.days(spark, d).select("sk_tempo", F.col("data").cast("string").alias("data_contrato"))
    f = f.join(o, "sk_orgao").join(c, "sk_credor", "left").join(F.broadcast(t), "sk_tempo", "left")  # the calendar has a fixed size
    return f.select("id_contrato_origem", "ano", "num_spu", "valor_contrato", "valor_empenhado", "valor_pago", "status", "flag_emergency", F.round("score_anomalia", 6).alias("score_anomalia"), "flag_anomalia", "model_version", "nome_orgao", "sigla_orgao", "nome_municipio", "nome_credor", "cnpj_cpf", "tipo_credor", "historico_infringement", "data_contrato")


_ANOMALIES = f"""SELECT fc.id_contrato_origem, fc.ano, fc.num_spu, fc.valor_contrato, fc.valor_empenhado, fc.valor_pago, fc.status, fc.flag_emergency, round(sc.score_anomalia, 6) AS score_anomalia, sc.flag_anomalia, sc.model_version,
  o.nome AS nome_orgao, o.sigla AS sigla_orgao, o.nome_municipio, cr.nome AS nome_credor, cr.cnpj_cpf, cr.tipo AS tipo_credor, cr.historico_infringement, strftime(te.data, '%Y-%m-%d') AS data_contrato
FROM fc JOIN sc ON sc.id_contrato_origem = fc.id_contrato_origem AND sc.ano = fc.ano
JOIN (SELECT * FROM dim_orgao QUALIFY row_number() OVER (PARTITION BY codigo, ano ORDER BY carregado_em DESC NULLS LAST, sk_orgao DESC) = 1) o ON o.sk_orgao = fc.sk_orgao
LEFT JOIN cr ON cr.sk_credor = fc.sk_credor LEFT JOIN te ON te.sk_tempo = fc.sk_tempo WHERE sc.score_anomalia >= {SCORE}"""


# Q-08, JN-01, JN-02, JN-04, PRJ-08, SL-04: all nineteen columns, in order of the score
@query(f"{_ANOMALIES} ORDER BY sc.score_anomalia DESC", "fc", "sc", "cr", "te")
def q08_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return _anomalies(spark, d).orderBy(F.desc("score_anomalia"))


# SL-05: the rows that are shown of it
@query(f"SELECT id_contrato_origem, ano, score_anomalia FROM ({_ANOMALIES}) ORDER BY score_anomalia DESC, id_contrato_origem, ano LIMIT {SHOWN}", "fc", "sc", "cr", "te")
def sl05_shown(spark: SparkSession, d: str) -> DataFrame:
    return _anomalies(spark, d).select("id_contrato_origem", "ano", "score_anomalia").orderBy(F.desc("score_anomalia"), "id_contrato_origem", "ano").limit(SHOWN)


# SL-04: an order only
@query("SELECT sk_orgao, nome FROM og ORDER BY nome NULLS LAST, sk_orgao", "og")
def sl04_ordered(spark: SparkSession, d: str) -> DataFrame:
    return gold.bodies(spark, d, {"sk_orgao", "nome"}).select("sk_orgao", "nome").orderBy(F.asc_nulls_last("nome"), "sk_orgao")


# Q-13: risk of contracts with a body, and their share of the value
@query("""SELECT count(*) FILTER (WHERE risco) AS contratos, CAST(sum(valor_contrato) AS DECIMAL(18,2)) AS valor_total, CAST(sum(valor_contrato) FILTER (WHERE risco) AS DECIMAL(18,2)) AS valor, count(DISTINCT nome) FILTER (WHERE risco) AS orgaos, count(DISTINCT nome) AS orgaos_total,
  round(avg(score_anomalia) FILTER (WHERE risco), 6) AS score_medio, round(100 * CAST(sum(valor_contrato) FILTER (WHERE risco) AS DOUBLE) / nullif(CAST(sum(valor_contrato) AS DOUBLE), 0), 3) AS pct_valor
FROM (SELECT fc.valor_contrato, og.nome, sc.score_anomalia, coalesce(sc.score_anomalia >= 0.70, false) AS risco FROM fc JOIN og ON og.sk_orgao = fc.sk_orgao LEFT JOIN sc ON sc.id_contrato_origem = fc.id_contrato_origem AND sc.ano = fc.ano)""", "fc", "og", "sc")  # fmt: skip
def q13_risk_totals(spark: SparkSession, d: str) -> DataFrame:
    f = gold.contracts(spark, d, {"sk_orgao", "valor_contrato"}).join(gold.bodies(spark, d, {"sk_orgao", "nome"}).select("sk_orgao", "nome"), "sk_orgao")
    f = f.join(gold.scores(spark, d, {"score_anomalia"}), ["id_contrato_origem", "ano"], "left")
    risky = F.coalesce(rules.risk_class(F.col("score_anomalia")).isin("Médio", "Alto"), F.lit(False))
    only = lambda c: F.when(risky, F.col(c))
    r = f.agg(F.count_if(risky).alias("contratos"), F.sum("valor_contrato").cast("decimal(18,2)").alias("valor_total"), F.sum(only("valor_contrato")).cast("decimal(18,2)").alias("valor"), F.countDistinct(only("nome")).alias("orgaos"), F.countDistinct("nome").alias("orgaos_total"), F.round(F.avg(only("score_anomalia")), 6).alias("score_medio"))
    return r.withColumn("pct_valor", rel.share(F.col("valor"), F.col("valor_total")))


def _forecast_error(spark: SparkSession, d: str, coverage: float) -> DataFrame:
    paid = _with_day(gold.bank_orders(spark, d, {"sk_tempo", "valor", "flag_cancelada"}).filter("not flag_cancelada"), gold.days(spark, d)).groupBy(F.col("t_ano").alias("a"), F.col("trimestre").alias("t")).agg(F.sum("valor").cast("double").alias("pago"))
    p = gold.forecasts(spark, d)
    universe = p.agg(F.countDistinct("codigo_orgao").alias("todos"))
    due = p.groupBy(F.col("ano_previsto").alias("a"), F.col("trimestre_previsto").alias("t")).agg(F.sum("valor_previsto_p50").alias("p50"), F.countDistinct("codigo_orgao").alias("n"))
    both = paid.join(due, ["a", "t"], "full_outer").crossJoin(F.broadcast(universe)).filter((F.col("pago") > 0) & (F.col("n") >= coverage * F.col("todos")))  # one row
    return both.agg(F.round(F.avg(F.abs(F.col("pago") - F.col("p50")) / F.col("pago") * 100), 4).alias("mape"), F.count("*").alias("trimestres"))


_ERROR = """WITH_ , real AS (SELECT te.ano AS a, te.trimestre AS t, sum(fo.valor)::DOUBLE AS pago FROM fo JOIN te USING (sk_tempo) WHERE NOT fo.flag_cancelada GROUP BY 1, 2),
  due AS (SELECT ano_previsto AS a, trimestre_previsto AS t, sum(valor_previsto_p50) AS p50, count(DISTINCT codigo_orgao) AS n FROM pv GROUP BY 1, 2)
SELECT round(avg(abs(pago - p50) / pago * 100), 4) AS mape, count(*) AS trimestres FROM real JOIN due ON real.a = due.a AND real.t = due.t WHERE pago > 0 AND n >= {0} * (SELECT count(DISTINCT codigo_orgao) FROM pv)"""


# Q-17, AG-30, JN-16
@query(_ERROR.format(COVERAGE).removeprefix("WITH_ "), "fo", "te", "pv")
def q17_forecast_error(spark: SparkSession, d: str) -> DataFrame:
    return _forecast_error(spark, d, COVERAGE)


# AG-30 with a coverage that small tables reach
@query(_ERROR.format(0.1).removeprefix("WITH_ "), "fo", "te", "pv")
def ag30_error_at_low_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _forecast_error(spark, d, 0.1)


# AG-15 over a category with more values than are kept: container names
@query(f"WITH n AS (SELECT usuario, count(*) AS c FROM sessoes_ssh WHERE usuario IS NOT NULL GROUP BY 1), top AS (SELECT usuario FROM n ORDER BY c DESC, usuario LIMIT {KEPT}) SELECT coalesce(top.usuario, 'OUTROS') AS usuario, count(*) AS linhas FROM sessoes_ssh s LEFT JOIN top ON top.usuario = s.usuario GROUP BY 1")
def ag15_top_other(spark: SparkSession, d: str) -> DataFrame:
    return rel.top_or_other(table(spark, d, "sessoes_ssh").select("usuario"), "usuario", KEPT).groupBy("usuario").agg(F.count("*").alias("linhas"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Backtests with the amount paid: a row for each body and quarter of both."""
    codes = gold.bodies(spark, d, {"sk_orgao", "codigo"}).select("sk_orgao", "codigo")
    paid = _with_day(gold.bank_orders(spark, d, {"sk_tempo", "sk_orgao", "valor", "flag_cancelada"}).filter("not flag_cancelada"), gold.days(spark, d)).join(codes, "sk_orgao")
    paid = paid.groupBy(F.col("codigo").alias("codigo_orgao"), F.col("t_ano").alias("ano_previsto"), F.col("trimestre").alias("trimestre_previsto")).agg(F.sum("valor").cast("double").alias("pago"))
    p = gold.forecasts(spark, d).filter("is_backtest").dropna(subset=["valor_previsto_p10", "valor_previsto_p50", "valor_previsto_p90"])
    return p.join(paid, ["codigo_orgao", "ano_previsto", "trimestre_previsto"])


_JUDGED = """, r AS (SELECT og.codigo, te.ano AS a, te.trimestre AS t, sum(fo.valor)::DOUBLE AS pago FROM fo JOIN te USING (sk_tempo) JOIN og ON og.sk_orgao = fo.sk_orgao WHERE NOT fo.flag_cancelada GROUP BY 1, 2, 3),
  j AS (SELECT pv.*, r.pago FROM pv JOIN r ON r.codigo = pv.codigo_orgao AND r.a = pv.ano_previsto AND r.t = pv.trimestre_previsto WHERE is_backtest AND valor_previsto_p10 IS NOT NULL AND valor_previsto_p50 IS NOT NULL AND valor_previsto_p90 IS NOT NULL) """


# AG-22: spread of the interval's coverage over the quarters
@query(_JUDGED + "SELECT round(stddev_samp(c), 6) AS desvio, count(*) AS trimestres FROM (SELECT avg(CASE WHEN pago IS NULL THEN NULL WHEN pago >= valor_previsto_p10 AND pago <= valor_previsto_p90 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS c FROM j GROUP BY ano_previsto, trimestre_previsto)", "fo", "te", "og", "pv")
def ag22_coverage_spread(spark: SparkSession, d: str) -> DataFrame:
    inside = F.col("pago").between(F.col("valor_previsto_p10"), F.col("valor_previsto_p90")).cast("double")
    folds = _judged(spark, d).groupBy("ano_previsto", "trimestre_previsto").agg(F.avg(inside).alias("c"))
    return folds.agg(F.round(F.stddev_samp("c"), 6).alias("desvio"), F.count("*").alias("trimestres"))


# AG-21: pinball losses of all three quantiles
@query(_JUDGED + "SELECT q, round(avg(CASE WHEN pago >= p THEN q * (pago - p) ELSE (1 - q) * (p - pago) END), 2) AS perda FROM (SELECT pago, unnest([0.1::DOUBLE, 0.5, 0.9]) AS q, unnest([valor_previsto_p10, valor_previsto_p50, valor_previsto_p90]) AS p FROM j) GROUP BY q", "fo", "te", "og", "pv")
def ag21_pinball(spark: SparkSession, d: str) -> DataFrame:
    j = _judged(spark, d)
    losses = [F.struct(F.lit(q).alias("q"), rel.pinball(F.col("pago"), F.col(f"valor_previsto_p{int(q * 100)}"), q).alias("x")) for q in (0.1, 0.5, 0.9)]
    return j.select(F.explode(F.array(*losses)).alias("l")).groupBy("l.q").agg(F.round(F.avg("l.x"), 2).alias("perda")).select("q", "perda")


# AG-31: bodies by anomalous contracts, and how many have none
@query(f"SELECT nome, n FROM (SELECT og.nome, count(*) FILTER (WHERE sc.score_anomalia >= {SCORE}) AS n FROM fc JOIN og ON og.sk_orgao = fc.sk_orgao LEFT JOIN sc ON sc.id_contrato_origem = fc.id_contrato_origem AND sc.ano = fc.ano GROUP BY 1) WHERE n > 0 UNION ALL SELECT 'DEMAIS', count(*) FROM (SELECT og.nome FROM fc JOIN og ON og.sk_orgao = fc.sk_orgao LEFT JOIN sc ON sc.id_contrato_origem = fc.id_contrato_origem AND sc.ano = fc.ano GROUP BY 1 HAVING count(*) FILTER (WHERE sc.score_anomalia >= {SCORE}) = 0)", "fc", "og", "sc")
def ag31_sizes(spark: SparkSession, d: str) -> DataFrame:
    f = gold.contracts(spark, d, {"sk_orgao"}).join(gold.bodies(spark, d, {"sk_orgao", "nome"}).select("sk_orgao", "nome"), "sk_orgao").join(gold.scores(spark, d, {"score_anomalia"}), ["id_contrato_origem", "ano"], "left")
    n = f.groupBy("nome").agg(F.count_if(F.col("score_anomalia") >= SCORE).alias("n"))
    return n.filter("n > 0").orderBy(F.desc("n"), "nome").unionByName(n.filter("n = 0").agg(F.count("*").alias("n")).select(F.lit("DEMAIS").alias("nome"), "n"))


# AG-16 over rows as loaded
@query("SELECT regexp_replace(lower(trim(id_contrato_origem)), '^0+(.)', '\\1') AS id_contrato_origem, ano, count(*) AS linhas FROM score_anomalia_contrato WHERE trim(id_contrato_origem) <> '' AND ano IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def ag16_repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "score_anomalia_contrato").select(plain_number(F.col("id_contrato_origem")).alias("id_contrato_origem"), "ano")
    return quality.unique(s, ["id_contrato_origem", "ano"])


# AG-23: description of the amounts of contracts
@query("SELECT coluna, count(v) AS n, round(100.0::DOUBLE * (count(*) - count(v)) / count(*), 4) AS pct_nulo, round(avg(v), 2) AS media, round(stddev_samp(v), 2) AS desvio, min(v) AS menor, max(v) AS maior FROM (SELECT unnest(['valor_contrato', 'valor_pago', 'valor_ajuste']) AS coluna, unnest([valor_contrato::DOUBLE, valor_pago::DOUBLE, valor_ajuste::DOUBLE]) AS v FROM fato_contrato) GROUP BY coluna")
def ag23_described(spark: SparkSession, d: str) -> DataFrame:
    cols = ["valor_contrato", "valor_pago", "valor_ajuste"]
    long = table(spark, d, "fato_contrato").select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "coluna", "v")
    return long.groupBy("coluna").agg(F.count("v").alias("n"), F.round(100.0 * F.count_if(F.col("v").isNull()) / F.count("*"), 4).alias("pct_nulo"), F.round(F.avg("v"), 2).alias("media"), F.round(F.stddev_samp("v"), 2).alias("desvio"), F.min("v").alias("menor"), F.max("v").alias("maior"))


# JN-08: commitments with and without the creditor of their number, both kinds of join
@query("SELECT 'dentro' AS juncao, count(*) AS linhas, count(c.cnpj_cpf) AS com_credor FROM fe JOIN (SELECT DISTINCT cnpj_cpf FROM dim_credor WHERE versao_atual) c ON c.cnpj_cpf = CAST(fe.codigocredor AS VARCHAR) UNION ALL SELECT 'esquerda', count(*), count(c.cnpj_cpf) FROM fe LEFT JOIN (SELECT DISTINCT cnpj_cpf FROM dim_credor WHERE versao_atual) c ON c.cnpj_cpf = CAST(fe.codigocredor AS VARCHAR)", "fe")
def jn08_both_kinds(spark: SparkSession, d: str) -> DataFrame:
    e = gold.commitments(spark, d).select("codigocredor")
    c = table(spark, d, "dim_credor").filter("versao_atual").select("cnpj_cpf").distinct()
    out = None
    for name, how in (("dentro", "inner"), ("esquerda", "left")):
        one = e.join(c, e["codigocredor"].cast("string") == c["cnpj_cpf"], how).agg(F.count("*").alias("linhas"), F.count("cnpj_cpf").alias("com_credor")).select(F.lit(name).alias("juncao"), "linhas", "com_credor")
        out = one if out is None else out.unionByName(one)
    return out


# JN-14: scores with their contract and three dimensions that may be missing
@query("SELECT sc.id_contrato_origem, sc.ano, round(sc.score_anomalia, 6) AS score, fc.valor_contrato, og.nome AS orgao, cr.nome AS credor, strftime(te.data, '%Y-%m-%d') AS dia, fc.flag_emergency FROM sc JOIN fc ON fc.id_contrato_origem = sc.id_contrato_origem AND fc.ano = sc.ano LEFT JOIN og ON og.sk_orgao = fc.sk_orgao LEFT JOIN cr ON cr.sk_credor = fc.sk_credor LEFT JOIN te ON te.sk_tempo = fc.sk_tempo WHERE sc.score_anomalia IS NOT NULL ORDER BY sc.score_anomalia DESC, sc.id_contrato_origem, sc.ano LIMIT 15", "sc", "fc", "og", "cr", "te")
def q20_report_contracts(spark: SparkSession, d: str) -> DataFrame:
    s = gold.scores(spark, d, {"score_anomalia"}).filter("score_anomalia is not null")
    f = s.join(gold.contracts(spark, d, {"sk_orgao", "sk_credor", "sk_tempo", "valor_contrato", "flag_emergency"}), ["id_contrato_origem", "ano"])
    f = f.join(gold.bodies(spark, d, {"sk_orgao", "nome"}).select("sk_orgao", F.col("nome").alias("orgao")), "sk_orgao", "left").join(gold.creditors(spark, d, {"nome"}).select("sk_credor", F.col("nome").alias("credor")), "sk_credor", "left")
    f = f.join(F.broadcast(gold.days(spark, d).select("sk_tempo", F.col("data").cast("string").alias("dia"))), "sk_tempo", "left")  # the calendar
    return f.orderBy(F.desc("score_anomalia"), "id_contrato_origem", "ano").limit(15).select("id_contrato_origem", "ano", F.round("score_anomalia", 6).alias("score"), "valor_contrato", "orgao", "credor", "dia", "flag_emergency")


# Q-20: the forecasts of a quarter that the report quotes
@query("SELECT codigo_orgao, nome_orgao, ano_previsto, trimestre_previsto, round(valor_previsto_p10, 2) AS p10, round(valor_previsto_p50, 2) AS p50, round(valor_previsto_p90, 2) AS p90 FROM pv WHERE NOT is_backtest AND ano_previsto = 2026 AND trimestre_previsto = 2 ORDER BY valor_previsto_p50 DESC NULLS LAST, codigo_orgao LIMIT 15", "pv")
def q20_report_forecasts(spark: SparkSession, d: str) -> DataFrame:
    p = gold.forecasts(spark, d).filter("not is_backtest and ano_previsto = 2026 and trimestre_previsto = 2").orderBy(F.desc_nulls_last("valor_previsto_p50"), "codigo_orgao").limit(15)
    return p.select("codigo_orgao", "nome_orgao", "ano_previsto", "trimestre_previsto", *[F.round(f"valor_previsto_p{q}", 2).alias(f"p{q}") for q in (10, 50, 90)])


# ST-05: forecasts and backtests, each deduplicated for itself, one below the other
@query("""SELECT kind, ano_previsto, count(*) AS n, round(sum(valor_previsto_p50), 2) AS p50 FROM (
  SELECT 'previsao' AS kind, * FROM (SELECT * REPLACE (regexp_replace(lower(trim(codigo_orgao)), '^0+(.)', '\\1') AS codigo_orgao) FROM previsao_pagamento_orgao WHERE NOT is_backtest AND trim(codigo_orgao) <> '') QUALIFY row_number() OVER (PARTITION BY codigo_orgao, ano_previsto, trimestre_previsto ORDER BY scored_at DESC NULLS LAST, valor_previsto_p50 DESC NULLS LAST) = 1
  UNION ALL
  SELECT 'retroativa', * FROM (SELECT * REPLACE (regexp_replace(lower(trim(codigo_orgao)), '^0+(.)', '\\1') AS codigo_orgao) FROM previsao_pagamento_orgao WHERE is_backtest AND trim(codigo_orgao) <> '') QUALIFY row_number() OVER (PARTITION BY codigo_orgao, ano_previsto, trimestre_previsto ORDER BY scored_at DESC NULLS LAST, valor_previsto_p50 DESC NULLS LAST) = 1
) GROUP BY kind, ano_previsto""")  # fmt: skip
def st05_concat(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "previsao_pagamento_orgao").withColumn("codigo_orgao", plain_number(F.col("codigo_orgao"))).filter("codigo_orgao is not null")
    key, order, want = ["codigo_orgao", "ano_previsto", "trimestre_previsto"], ["scored_at", "valor_previsto_p50"], ["valor_previsto_p50"]
    parts = [rel.dedup(rows.filter(c), key, order, want, tie=False).withColumn("kind", F.lit(k)) for k, c in (("previsao", "not is_backtest"), ("retroativa", "is_backtest"))]
    return parts[0].unionByName(parts[1]).groupBy("kind", "ano_previsto").agg(F.count("*").alias("n"), F.round(F.sum("valor_previsto_p50"), 2).alias("p50"))


# PRJ-09: the predicate over amounts as they are and over payments made three times as high
@query("SELECT ano, count(*) AS contratos, count(*) FILTER (WHERE (3 * valor_pago > 2 * valor_contrato OR 3 * valor_empenhado > 2 * valor_contrato) AND NOT coalesce(abs(3 * valor_pago::DOUBLE - (valor_contrato + valor_aditivo)::DOUBLE) <= 0.01 * (valor_contrato + valor_aditivo)::DOUBLE, false)) AS acima FROM fc GROUP BY ano", "fc")
def prj09_overpaid_tripled(spark: SparkSession, d: str) -> DataFrame:
    f = gold.contracts(spark, d, {"valor_pago", "valor_empenhado", "valor_contrato", "valor_aditivo"})
    paid, due, total = F.col("valor_pago") * 3, F.col("valor_empenhado") * 3, (F.col("valor_contrato") + F.col("valor_aditivo")).cast("double")
    explained = F.coalesce(F.abs(paid.cast("double") - total) <= 0.01 * total, F.lit(False))
    above = ((paid > 2 * F.col("valor_contrato")) | (due > 2 * F.col("valor_contrato"))) & ~explained
    return f.groupBy("ano").agg(F.count("*").alias("contratos"), F.count_if(above).alias("acima"))


# OP-SCD: all extracts one after the other
@query(f"""WITH base AS (SELECT cnpj_cpf, nome, tipo, historico_infringement, CAST(valido_de AS TIMESTAMP) AS de FROM dim_credor WHERE versao_atual QUALIFY row_number() OVER (PARTITION BY cnpj_cpf ORDER BY valido_de DESC, carregado_em DESC, sk_credor DESC) = 1),
  snap AS (SELECT regexp_replace(cnpj_cpf, '[^0-9]', '', 'g') AS cnpj_cpf, trim(nome) AS nome, tipo, historico_infringement, CAST(data_snapshot AS TIMESTAMP) AS de FROM snapshot_credor
    QUALIFY row_number() OVER (PARTITION BY regexp_replace(cnpj_cpf, '[^0-9]', '', 'g'), data_snapshot ORDER BY carregado_em DESC, trim(nome) DESC NULLS LAST, tipo DESC NULLS LAST, historico_infringement DESC NULLS LAST) = 1),
  seen AS (SELECT *, 0 AS k FROM base UNION ALL SELECT *, 1 FROM snap),
  lagged AS (SELECT *, row_number() OVER w AS n, lag(nome) OVER w AS bn, lag(tipo) OVER w AS bt, lag(historico_infringement) OVER w AS bh FROM seen WINDOW w AS (PARTITION BY cnpj_cpf ORDER BY k, de)),
  v AS (SELECT * FROM lagged WHERE n = 1 OR nome IS DISTINCT FROM bn OR tipo IS DISTINCT FROM bt OR historico_infringement IS DISTINCT FROM bh)
SELECT cnpj_cpf, nome, tipo, historico_infringement, strftime(de, '{_H}') AS valido_de, strftime(lead(de) OVER (PARTITION BY cnpj_cpf ORDER BY k, de), '{_H}') AS valido_ate FROM v""")  # fmt: skip
def op_scd(spark: SparkSession, d: str) -> DataFrame:
    """Each extract is one step of the versioned dimension; the versions are written after each, so plans don't grow."""
    s = table(spark, d, "snapshot_credor").select(digits(F.col("cnpj_cpf")).alias("cnpj_cpf"), F.trim("nome").alias("nome"), "tipo", "historico_infringement", "carregado_em", "data_snapshot")
    base = table(spark, d, "dim_credor").filter("versao_atual")
    base = rel.dedup(base, ["cnpj_cpf"], ["valido_de", "carregado_em", "sk_credor"], ["nome", "tipo", "historico_infringement", "valido_de"], tie=False)
    state = base.select("cnpj_cpf", "nome", "tipo", "historico_infringement", F.col("valido_de").cast("timestamp").alias("valido_de"), F.lit(None).cast("timestamp").alias("valido_ate"))
    for r in s.select("data_snapshot").distinct().orderBy("data_snapshot").collect():  # a row a month
        day = r["data_snapshot"]
        one = rel.dedup(s.filter(F.col("data_snapshot") == F.lit(day)), ["cnpj_cpf"], ["carregado_em", "nome", "tipo", "historico_infringement"], ["nome", "tipo", "historico_infringement"], tie=False)
        state = written(rel.scd2(state, one, "cnpj_cpf", ["nome", "tipo", "historico_infringement"], F.lit(day).cast("timestamp")), "scd")
    return state.withColumn("valido_de", F.date_format("valido_de", _SPARK)).withColumn("valido_ate", F.date_format("valido_ate", _SPARK))


# SNK-05, SNK-06, SNK-07, SNK-08: a stored table, partitioned, merged in three batches, one of them a replay with a new column
@query(f"SELECT id_ob_origem, ano, valor, strftime(carregado_em, '{_H}') AS carregado_em FROM fo", "fo")
def snk06_lake_merge(spark: SparkSession, d: str) -> DataFrame:
    lake = Lake(spark, _scratch(spark))
    rows = table(spark, d, "fato_ordem_bancaria").filter("id_ob_origem is not null and ano is not null").withColumn("sk_orgao", plain_key(F.col("sk_orgao")))
    order = ["carregado_em", "sk_orgao", "valor", "status", "natureza"]
    cut = F.lit("2024-01-01").cast("timestamp_ntz")
    old, new = (rel.dedup(rows.filter(c), ["id_ob_origem", "ano"], order) for c in (F.col("carregado_em") < cut, F.col("carregado_em") >= cut))
    for batch in (old, new, old.withColumn("nova", F.lit(1))):
        lake.merge("silver.ordens", batch, ["id_ob_origem", "ano"], "carregado_em", ["ano"])
    return lake.read("silver.ordens").select("id_ob_origem", "ano", "valor", F.date_format("carregado_em", _SPARK).alias("carregado_em"))


# SNK-10, SNK-11, SNK-14, SRC-16, SRC-18: appends, distinct rows, an older version, the list of tables
@query("SELECT 'agora' AS versao, count(*) AS linhas FROM sessoes_ssh UNION ALL SELECT 'antes', count(*) FROM sessoes_ssh WHERE evento = 'login' UNION ALL SELECT 'distintas', count(*) FROM (SELECT DISTINCT usuario, evento FROM sessoes_ssh) UNION ALL SELECT 'tabelas', 2")
def snk10_lake_appends(spark: SparkSession, d: str) -> DataFrame:
    lake, s = Lake(spark, _scratch(spark)), table(spark, d, "sessoes_ssh")
    lake.ensure("ops.sessoes", s.schema)
    lake.append("ops.sessoes", s.filter("evento = 'login'"))
    before = lake.log("ops.sessoes")[-1]["version"]
    lake.append("ops.sessoes", s.filter("evento <> 'login'").drop("origem_ip"))
    lake.replace_distinct("ops.pares", s.select("usuario", "evento"))
    parts = [("agora", lake.read("ops.sessoes")), ("antes", lake.read("ops.sessoes", version=before)), ("distintas", lake.read("ops.pares")), ("tabelas", spark.createDataFrame([(x,) for x in lake.tables()], "t string"))]
    out = None
    for n, df in parts:
        one = df.agg(F.count("*").alias("linhas")).select(F.lit(n).alias("versao"), "linhas")
        out = one if out is None else out.unionByName(one)
    return out


# SNK-16: a retention of 90 days before the newest row
@query("SELECT CAST(CAST(coletado_em AS DATE) AS VARCHAR) AS dia, count(*) AS linhas FROM infra_metricas_containers WHERE coletado_em >= (SELECT max(coletado_em) FROM infra_metricas_containers) - INTERVAL 1 DAY GROUP BY 1")
def snk16_retained(spark: SparkSession, d: str) -> DataFrame:
    lake, m = Lake(spark, _scratch(spark)), table(spark, d, "infra_metricas_containers")
    lake.replace("ops.metricas", m.withColumn("dia", F.to_date("coletado_em")), ["dia"])
    newest = m.agg(F.max("coletado_em").cast("timestamp").alias("m")).first()["m"]
    lake.retain("ops.metricas", "coletado_em", 1, F.lit(newest).cast("timestamp"))
    return lake.read("ops.metricas").filter("coletado_em is not null").groupBy(F.to_date("coletado_em").cast("string").alias("dia")).agg(F.count("*").alias("linhas"))


# SNK-12, TM-05: counts of loads, the last of each source and day
@query("SELECT lower(trim(fonte)) AS fonte, CAST(sum(registros) AS BIGINT) AS registros FROM (SELECT fonte, registros FROM bronze_ingestao WHERE registros IS NOT NULL AND fonte IS NOT NULL) GROUP BY 1")
def snk12_counts(spark: SparkSession, d: str) -> DataFrame:
    lake = Lake(spark, _scratch(spark))
    n = table(spark, d, "bronze_ingestao").filter("registros is not null and fonte is not null").groupBy(F.lower(F.trim("fonte")).alias("fonte")).agg(F.sum("registros").alias("n")).collect()  # the few sources
    counts = {r["fonte"]: int(r["n"]) for r in n}
    for value in (0, 1):  # the second call of a day replaces the first one's rows
        silver.record_counts(lake, "2026-01-01", {k: v * value for k, v in counts.items()})
    return lake.read("audit.bronze_ingestao").select("fonte", "registros")


# TM-01 … TM-04: the mark of each source and where its next run starts
@query("""SELECT fonte, CAST(m AS VARCHAR) AS marca, CAST(CAST(m - INTERVAL 7 DAY AS DATE) AS VARCHAR) AS inicio FROM (SELECT lower(trim(fonte)) AS fonte, max(CASE WHEN regexp_matches(trim(data_extracao), '^[0-9]{2}/') THEN CAST(strptime(trim(data_extracao), '%d/%m/%Y') AS DATE) ELSE CAST(substr(trim(data_extracao), 1, 10) AS DATE) END) AS m FROM bronze_ingestao WHERE fonte IS NOT NULL GROUP BY 1) WHERE m IS NOT NULL""")
def tm01_marks(spark: SparkSession, d: str) -> DataFrame:
    lake = Lake(spark, _scratch(spark))
    b = table(spark, d, "bronze_ingestao").filter("fonte is not null").select(F.lower(F.trim("fonte")).alias("fonte"), rules.as_day(F.trim("data_extracao")).cast("string").alias("dia"))
    seen = b.groupBy("fonte").agg(F.min("dia").alias("a"), F.max("dia").alias("b")).filter("b is not null").orderBy("fonte").collect()  # the few sources
    out = []
    for r in seen:
        for day in (r["a"], r["b"], r["a"], None):  # forward, never back
            incremental.advance(lake, r["fonte"], day)
        mark = incremental.watermark(lake, r["fonte"])
        out.append((r["fonte"], mark, incremental.start_date([mark])))
    return spark.createDataFrame(out, "fonte string, marca string, inicio string")


# SRC-06, SRC-07, SRC-09, SNK-01, SNK-02, FN-06: an extract written below year and month, and read back
@query("SELECT year(CAST(o_orderdate AS DATE))::INTEGER AS ano, month(CAST(o_orderdate AS DATE))::INTEGER AS mes, count(*) AS linhas FROM orders GROUP BY 1, 2")
def src06_batches(spark: SparkSession, d: str) -> DataFrame:
    root = _scratch(spark)
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("dia"))
    batches.write_batch(o, root, "pedidos", "2026-01-01", F.col("dia"))
    back = batches.read_batch(spark, root, "pedidos", "2026-01-01", T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("dia", T.StringType())]))
    y, m = rules.year_month(F.col("dia"))
    return back.groupBy(y.alias("ano"), m.alias("mes")).agg(F.count("*").alias("linhas"))


# SRC-03, SRC-04: a range of text dates
@query("SELECT linha_id FROM empenhos WHERE dataemissao >= '2023-01-01' AND dataemissao <= '2024-06-30'")
def src03_range(spark: SparkSession, d: str) -> DataFrame:
    return relational.read_range(spark, "empenhos", "2023-01-01", "2024-06-30", parquet=f"{d}/empenhos.parquet").select("linha_id")


# SRC-12, FN-14, FN-15: container statistics from lines as a collector prints them
@query("SELECT container, count(*) AS linhas, round(sum(coalesce(round(cpu_percent, 2), 0)), 2) AS cpu, CAST(sum(CASE WHEN mem_usage_bytes IS NULL THEN 0 ELSE floor(mem_usage_bytes / 1024) * 1024 END) AS BIGINT) AS memoria FROM infra_metricas_containers WHERE container IS NOT NULL GROUP BY 1")
def src12_container_stats(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "infra_metricas_containers").filter("container is not null")
    used = F.coalesce(F.concat(F.floor(F.col("mem_usage_bytes") / 1024).cast("string"), F.lit("KiB")), F.lit(""))
    percent = F.coalesce(F.concat(F.round("cpu_percent", 2).cast("decimal(12,2)").cast("string"), F.lit("%")), F.lit(""))
    lines = m.select(F.to_json(F.struct(F.col("container").alias("Name"), percent.alias("CPUPerc"), F.concat(used, F.lit(" / 6GiB")).alias("MemUsage"), F.lit("1%").alias("MemPerc"))).alias("value"))
    return telemetry.container_stats(lines).groupBy("container").agg(F.count("*").alias("linhas"), F.round(F.sum("cpu_percent"), 2).alias("cpu"), F.sum("mem_usage_bytes").alias("memoria"))


# SRC-13: disk usage lines
@query("SELECT CAST(c_custkey AS VARCHAR) AS ponto, CAST(c_custkey AS BIGINT) * 100000000 AS total_bytes, CAST(c_custkey AS BIGINT) * 50000000 AS usado_bytes, CAST(50.0 AS DOUBLE) AS percentual FROM customer WHERE c_custkey >= 10")
def src13_disks(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("bigint").alias("k"))
    return telemetry.disk_usage(c.select(F.concat_ws("  ", F.col("k").cast("string"), (F.col("k") * 100_000_000).cast("string"), (F.col("k") * 50_000_000).cast("string"), F.lit("50%")).alias("value")))


# SRC-14: sessions from a journal
@query(f"SELECT evento, usuario, CASE WHEN evento = 'login' THEN origem_ip END AS origem_ip, sessao_pid, strftime(timestamp_evento, '{_H}') AS quando FROM sessoes_ssh WHERE sessao_pid IS NOT NULL AND usuario IS NOT NULL AND timestamp_evento IS NOT NULL AND (evento = 'logout' OR origem_ip IS NOT NULL)")
def src14_sessions(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sessoes_ssh").filter("sessao_pid is not null and usuario is not null and timestamp_evento is not null and (evento = 'logout' or origem_ip is not null)")
    head = F.concat(F.date_format("timestamp_evento", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00 no1 sshd["), "sessao_pid", F.lit("]: "))
    login = F.concat(head, F.lit("Accepted publickey for "), "usuario", F.lit(" from "), "origem_ip", F.lit(" port 50022 ssh2"))
    logout = F.concat(head, F.lit("pam_unix(sshd:session): session closed for user "), "usuario")
    got = telemetry.ssh_sessions(s.select(F.when(F.col("evento") == "login", login).otherwise(logout).alias("value")))
    return got.select("evento", "usuario", "origem_ip", "sessao_pid", F.date_format("timestamp_evento", _SPARK).alias("quando"))


# SRC-15, FN-16: commands from an audit trail
@query("SELECT usuario, strftime(timestamp_evento, '%Y-%m-%d %H:%M:%S.000') AS timestamp_evento, 'ls -la ' || evento AS comando, count(*) AS n FROM sessoes_ssh WHERE usuario IS NOT NULL AND timestamp_evento IS NOT NULL AND evento IS NOT NULL GROUP BY 1, 2, 3")
def src15_commands(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sessoes_ssh").filter("usuario is not null and timestamp_evento is not null and evento is not null")
    stamp = F.concat(F.lit("msg=audit("), F.date_format("timestamp_evento", "MM/dd/yy HH:mm:ss"), F.lit(".000:7) : "))
    blocks = s.select(F.concat(F.lit("\ntype=PROCTITLE "), stamp, F.lit("proctitle=ls -la "), "evento", F.lit("\ntype=SYSCALL "), stamp, F.lit("auid="), "usuario", F.lit(" uid=root comm=ls\n")).alias("value"))
    return telemetry.audit_commands(blocks).groupBy("usuario", "timestamp_evento", "comando").agg(F.count("*").alias("n"))


# FN-18, FN-25: amounts of a text that no allowed value supports, and the text made safe for Markdown
@query("SELECT ano, count(*) FILTER (WHERE abs(v - p) > 0.005 * greatest(abs(p), 1.0)) AS sem_apoio, count(*) FILTER (WHERE v IS NOT NULL) AS cifroes FROM (SELECT ano, CAST(valor AS DOUBLE) AS v, round(CAST(valor AS DOUBLE) / 1000) * 1000 AS p FROM fo WHERE valor >= 0) GROUP BY ano", "fo")
def fn18_unsupported(spark: SparkSession, d: str) -> DataFrame:
    f = gold.bank_orders(spark, d, {"valor"}).filter("valor >= 0")
    text = F.concat(F.lit("Pago "), rules.reais(F.col("valor")), F.lit("."))
    bad = rules.unsupported(rules.amounts(text), F.array(F.round(F.col("valor").cast("double") / 1000) * 1000))
    return f.groupBy("ano").agg(F.count_if(F.size(bad) > 0).alias("sem_apoio"), F.count_if(rules.markdown_safe(text).contains("\\$")).alias("cifroes"))


# FN-19: adaptive amounts
@query("SELECT ano, faixa, count(*) AS n FROM (SELECT ano, CASE WHEN abs(valor) >= 1e9 THEN 'bi' WHEN abs(valor) >= 1e6 THEN 'mi' WHEN abs(valor) >= 1e3 THEN 'mil' WHEN valor IS NULL THEN 'informado' ELSE 'inteiro' END AS faixa FROM fo) GROUP BY 1, 2", "fo")
def fn19_scaled(spark: SparkSession, d: str) -> DataFrame:
    last = F.regexp_extract(rules.reais_scaled(F.col("valor")), r"([a-z]+)$", 1)
    return gold.bank_orders(spark, d, {"valor"}).groupBy("ano", F.when(last == "", "inteiro").otherwise(last).alias("faixa")).agg(F.count("*").alias("n"))


# OP-VALID: the counts of a batch that passes, and the error of one that doesn't
@query("SELECT 'unidade_gestora' AS fonte, count(*) AS registros, true AS recusada FROM dim_orgao")
def op_valid(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "dim_orgao")
    n = quality.validate_batch(o, ["codigo", "ano", "nome"], 1, "unidade_gestora")["registros"]
    try:
        quality.validate_batch(o.withColumn("codigo", F.when(F.col("codigo") == F.lit(o.agg(F.min("codigo")).first()[0]), "  ").otherwise(F.col("codigo"))), ["codigo", "ano", "nome"], 1, "unidade_gestora")
        refused = False
    except quality.InvalidBatch:
        refused = True
    return spark.createDataFrame([("unidade_gestora", n, refused)], "fonte string, registros bigint, recusada boolean")


# SL-08: the ends of each user's sessions (none of the middle)
@query("SELECT registro_id FROM (SELECT registro_id, row_number() OVER (PARTITION BY usuario ORDER BY registro_id) AS a, row_number() OVER (PARTITION BY usuario ORDER BY registro_id DESC) AS b FROM sessoes_ssh) WHERE a <= 3 OR b <= 3")
def sl08_ends(spark: SparkSession, d: str) -> DataFrame:
    return quality.batch_sample(table(spark, d, "sessoes_ssh"), 3, 0, "usuario", "registro_id").select("registro_id")


# OP-TUNE, OP-QREG, SL-07: the loss of each candidate over the folds (rows only: fits can't be told in SQL)
@query()
def op_tune(spark: SparkSession, d: str) -> DataFrame:
    from erario.ml import forecast

    grid = forecast.GRID
    best, means = forecast.tune(spark, forecast.bounded(QUERIES["op_panel"](spark, d)), grid)
    return spark.createDataFrame([(i, float(m), grid[i] == best) for i, m in enumerate(means)], "candidato int, perda double, escolhido boolean")


# WN-01 over whole rows, ties by the row itself: as many rows as keys, each a row of the table
@query("SELECT count(*) AS linhas, count(*) AS da_tabela FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def wn01_whole_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem")
    one = rel.dedup(rows.unionByName(rows), ["l_orderkey", "l_linenumber"])
    return one.agg(F.count("*").alias("linhas")).crossJoin(one.join(rows, rows.columns, "left_semi").agg(F.count("*").alias("da_tabela")))  # one row each


# Distinct users by day without blanks around them, by the library's trim
@query("SELECT CAST(CAST(timestamp_evento AS DATE) AS VARCHAR) AS dia, count(DISTINCT trim(usuario)) AS usuarios FROM sessoes_ssh WHERE timestamp_evento IS NOT NULL GROUP BY 1")
def ag26_users(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sessoes_ssh").filter("timestamp_evento is not null")
    return s.groupBy(F.to_date("timestamp_evento").cast("string").alias("dia")).agg(F.countDistinct(stripped(F.col("usuario"))).alias("usuarios"))


# WN-10, WN-11: the quarters a walk-forward test is cut into, by the library's folds
@query(", q AS (SELECT DISTINCT te.ano AS ano, te.trimestre AS trimestre FROM fo JOIN te USING (sk_tempo) WHERE NOT fo.flag_cancelada), r AS (SELECT *, row_number() OVER (ORDER BY ano DESC, trimestre DESC) AS k, row_number() OVER (ORDER BY ano, trimestre) AS n FROM q) SELECT ano, trimestre, CAST(n - 1 AS INTEGER) AS treino FROM r WHERE k BETWEEN 2 AND 5", "fo", "te")
def wn10_folds(spark: SparkSession, d: str) -> DataFrame:
    from erario.ml import forecast

    f = _with_day(gold.bank_orders(spark, d, {"sk_tempo", "flag_cancelada"}).filter("not flag_cancelada"), gold.days(spark, d))
    qs = [(r["t_ano"], r["trimestre"]) for r in f.select("t_ano", "trimestre").distinct().collect()]  # a row a quarter
    return spark.createDataFrame([(a, t, len(train)) for train, (a, t) in forecast.folds(qs)], "ano int, trimestre int, treino int")
