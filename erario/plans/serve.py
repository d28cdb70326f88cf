"""Serving queries over the conformed frames, written once as SQL that both engines read.

A body names its frames in braces; ``run`` builds only those frames and lets Catalyst plan the rest. Filters that a
caller may leave out are column predicates (``optional_in``), not text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.plans import gold

_MONEY = "CAST(sum({0}) AS DECIMAL(18,2))"


def optional_in(df: DataFrame, column: str | Column, values: Sequence) -> DataFrame:
    """Rows whose column is among ``values``; all rows where the list is empty."""
    c = F.col(column) if isinstance(column, str) else column
    return df.filter(c.isin(list(values))) if values else df


def frames_of(body: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", body)))


def run(body: str, frames: dict | None = None):
    """Query for Spark from a body, over the frames of the data directory or those given (``gold.stored``).

    A frame is built with only the columns whose names occur in the body.
    """
    words = set(re.findall(r"\w+", body))

    def query(spark: SparkSession, sf_dir: str = "") -> DataFrame:
        return spark.sql(body, **{n: (frames or gold.FRAMES)[n](spark, sf_dir, words) for n in frames_of(body)})

    return query


def sql(body: str) -> str:
    """The same query for DuckDB, with the frames as common table expressions."""
    names = frames_of(body)
    return f"WITH {', '.join(gold.SQL[n] for n in names)} {body.format(**{n: n for n in names})}"


#: Q-01 … Q-21 and the plain relational operators. Scores below 0.49 are not shown by the histogram.
BODIES: dict[str, str] = {
    # Q-01, ST-04, ST-06
    "q01_years": "SELECT DISTINCT ano FROM (SELECT ano FROM {fc} UNION SELECT ano FROM {fo})",
    "q01_bodies": "SELECT DISTINCT codigo, nome, sigla FROM {og} WHERE sigla IS NOT NULL",
    # Q-03, AG-08, JN-07, PRJ-07
    "q03_last_payment": "SELECT CAST(max(t.data) AS STRING) AS ultima FROM {fo} f JOIN {te} t ON f.sk_tempo = t.sk_tempo WHERE NOT f.flag_cancelada",
    # Q-04, AG-03, AG-18
    "q04_totals": "SELECT count(*) AS contratos, coalesce(CAST(sum(valor_contrato) AS DECIMAL(18,2)), 0) AS contratado, coalesce(CAST(sum(valor_pago) AS DECIMAL(18,2)), 0) AS pago, CASE WHEN sum(valor_contrato) <> 0 THEN round(CAST(sum(valor_pago) AS DOUBLE) / CAST(sum(valor_contrato) AS DOUBLE) * 100, 3) ELSE 0 END AS pct_usado FROM {fc}",
    # Q-06, AG-04, SL-01, SL-02
    "q06_bodies_top": "SELECT o.nome, o.sigla, CAST(sum(f.valor_pago) AS DECIMAL(18,2)) AS pago, CAST(sum(f.valor_empenhado) AS DECIMAL(18,2)) AS empenhado FROM {fc} f JOIN {og} o ON f.sk_orgao = o.sk_orgao GROUP BY o.nome, o.sigla ORDER BY pago DESC NULLS LAST, o.nome, o.sigla LIMIT 10",
    # Q-10, AG-05, AG-26
    "q10_value_bodies": "SELECT CAST(sum(f.valor_contrato) AS DECIMAL(18,2)) AS valor, count(DISTINCT o.codigo) AS orgaos FROM {fc} f JOIN {og} o ON f.sk_orgao = o.sk_orgao",
    # Q-11, JN-12, AG-31
    "q11_bodies_anomalous": "SELECT a.nome, a.contratos, coalesce(b.anomalos, 0) AS anomalos, round(100.0 * coalesce(b.anomalos, 0) / CAST(a.contratos AS DOUBLE), 3) AS pct FROM (SELECT o.nome, count(*) AS contratos FROM {fc} f JOIN {og} o ON f.sk_orgao = o.sk_orgao GROUP BY o.nome) a LEFT JOIN (SELECT o.nome, count(*) AS anomalos FROM {fc} f JOIN {og} o ON f.sk_orgao = o.sk_orgao JOIN {sc} s ON s.id_contrato_origem = f.id_contrato_origem AND s.ano = f.ano WHERE s.score_anomalia >= 0.7 GROUP BY o.nome) b ON a.nome = b.nome",
    # Q-12, AG-02, AG-07
    "q12_yearly_share": "SELECT f.ano, count(*) AS contratos, CAST(sum(CASE WHEN s.score_anomalia >= 0.7 THEN 1 ELSE 0 END) AS BIGINT) AS anomalos, count(*) FILTER (WHERE s.score_anomalia IS NULL) AS sem_score, round(100.0 * CAST(sum(CASE WHEN s.score_anomalia >= 0.7 THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE), 3) AS pct FROM {fc} f LEFT JOIN {sc} s ON s.id_contrato_origem = f.id_contrato_origem AND s.ano = f.ano GROUP BY f.ano",
    # Q-14
    "q14_forecast_universe": "SELECT ano_previsto, count(DISTINCT codigo_orgao) AS orgaos FROM {pv} GROUP BY ano_previsto",
    # Q-15, AG-04, JN-07
    "q15_paid_by_quarter": "SELECT t.trimestre, CAST(sum(f.valor) AS DECIMAL(18,2)) AS pago FROM {fo} f JOIN {te} t ON f.sk_tempo = t.sk_tempo WHERE t.ano = 2024 AND NOT f.flag_cancelada GROUP BY t.trimestre",
    # Q-16, AG-05
    "q16_forecast_by_quarter": "SELECT ano_previsto, trimestre_previsto, round(sum(valor_previsto_p10), 2) AS p10, round(sum(valor_previsto_p50), 2) AS p50, round(sum(valor_previsto_p90), 2) AS p90, count(DISTINCT codigo_orgao) AS orgaos, round(CAST(count(DISTINCT codigo_orgao) AS DOUBLE) / (SELECT CAST(count(DISTINCT codigo_orgao) AS DOUBLE) FROM {pv}), 6) AS cobertura FROM {pv} WHERE NOT is_backtest GROUP BY ano_previsto, trimestre_previsto",
    # Q-18
    "q18_history": "SELECT t.ano, t.trimestre, concat(CAST(t.ano AS STRING), '-T', CAST(t.trimestre AS STRING)) AS rotulo, CAST(sum(f.valor) AS DECIMAL(18,2)) AS pago FROM {fo} f JOIN {te} t ON f.sk_tempo = t.sk_tempo WHERE NOT f.flag_cancelada GROUP BY t.ano, t.trimestre",
    # Q-19, SL-01, WN-09
    "q19_forecast_top": "SELECT codigo_orgao, ano_previsto, trimestre_previsto, round(valor_previsto_p50, 2) AS p50, round(greatest(valor_previsto_p50 - valor_previsto_p10, 0), 2) AS erro_menos, round(greatest(valor_previsto_p90 - valor_previsto_p50, 0), 2) AS erro_mais FROM {pv} WHERE NOT is_backtest AND valor_previsto_p50 IS NOT NULL ORDER BY valor_previsto_p50 DESC, codigo_orgao, ano_previsto, trimestre_previsto LIMIT 5",
    "q20_preview_counts": "SELECT count(*) AS anomalias, CAST(sum(f.valor_contrato) AS DECIMAL(18,2)) AS valor FROM {fc} f JOIN {sc} s ON s.id_contrato_origem = f.id_contrato_origem AND s.ano = f.ano WHERE s.score_anomalia >= 0.9",
    # Q-21, AG-01, ST-02
    "q21_volumes": "SELECT 'contratos' AS tabela, count(*) AS linhas FROM {fc} UNION ALL SELECT 'ordens', count(*) FROM {fo} UNION ALL SELECT 'empenhos', count(*) FROM {fe} UNION ALL SELECT 'credores', count(*) FROM {cr} UNION ALL SELECT 'orgaos', count(*) FROM {og}",
    # Q-21, AG-24
    "q21_key_uniqueness": "SELECT count(*) AS linhas, count(DISTINCT concat(CAST(ano AS STRING), '/', CAST(linha_id AS STRING))) AS chaves FROM {fe}",
    # Q-21, AG-02, AG-08, AG-23
    "q21_dates": "SELECT ano, CAST(min(data) AS STRING) AS primeira, CAST(max(data) AS STRING) AS ultima, count(*) FILTER (WHERE data IS NULL) AS sem_data, round(100.0 * CAST(count(*) FILTER (WHERE valor IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE), 4) AS pct_sem_valor FROM {fe} GROUP BY ano",
    # Q-21: versions of creditors by number
    "q21_versions": "SELECT versoes, count(*) AS credores FROM (SELECT cnpj_cpf, count(*) AS versoes FROM {cr} GROUP BY cnpj_cpf) v GROUP BY versoes",
    # Q-21, AG-25
    "q21_statuses": "SELECT status, count(*) AS linhas FROM {fo} GROUP BY status",
    # JN-11
    "jn11_scalars": "SELECT (SELECT count(*) FROM {fc}) AS contratos, (SELECT count(*) FROM {sc}) AS scores, round(100.0 * (SELECT CAST(count(*) AS DOUBLE) FROM {sc}) / nullif((SELECT CAST(count(*) AS DOUBLE) FROM {fc}), 0), 3) AS pct",
    # JN-08: commitments with the body of their year, cast keys; and those without one
    "jn08_cross_layer": "SELECT o.tipo_administracao, count(*) AS empenhos, CAST(sum(e.valor) AS DECIMAL(18,2)) AS valor FROM {fe} e JOIN {og} o ON CAST(e.codigoug AS STRING) = o.codigo AND e.ano = o.ano GROUP BY o.tipo_administracao",
    "jn02_composite_left": "SELECT e.ano, count(*) AS empenhos, count(o.sk_orgao) AS com_orgao FROM {fe} e LEFT JOIN {og} o ON e.codigoug = o.codigo AND e.ano = o.ano GROUP BY e.ano",
    # PRJ-03, PRJ-04, PRJ-05
    "prj_predicates": "SELECT cnpj_cpf, valido_ate IS NULL AS aberta, coalesce(tipo, '?') IN ('PF', 'PJ') AS tipo_valido FROM {cr} WHERE tipo IS NOT NULL AND trim(nome) <> ''",
    # PRJ-09
    "prj09_overpaid": "SELECT ano, count(*) AS contratos, count(*) FILTER (WHERE (valor_pago > 2 * valor_contrato OR valor_empenhado > 2 * valor_contrato) AND NOT coalesce(abs(CAST(valor_pago AS DOUBLE) - CAST(valor_contrato + valor_aditivo AS DOUBLE)) <= 0.01 * CAST(valor_contrato + valor_aditivo AS DOUBLE), false)) AS acima FROM {fc} GROUP BY ano",
    # PRJ-10
    "prj10_bin": "SELECT id_contrato_origem, ano FROM {sc} WHERE score_anomalia >= 0.55 AND score_anomalia < 0.60",
    # AG-12
    "ag12_thresholds": "SELECT count(*) AS n, count(*) FILTER (WHERE score_anomalia >= 0.70) AS a70, count(*) FILTER (WHERE score_anomalia >= 0.80) AS a80, count(*) FILTER (WHERE score_anomalia >= 0.90) AS a90, count(*) FILTER (WHERE score_anomalia >= 0.95) AS a95, round(CAST(count(*) FILTER (WHERE score_anomalia >= 0.70) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS parte70 FROM {sc}",
    # AG-28
    "ag28_means_by_flag": "SELECT f.flag_emergency, count(s.score_anomalia) AS n, round(avg(s.score_anomalia), 6) AS media FROM {fc} f JOIN {sc} s ON s.id_contrato_origem = f.id_contrato_origem AND s.ano = f.ano GROUP BY f.flag_emergency",
    # AG-09
    "ag09_mean_by_version": "SELECT model_version, round(avg(score_anomalia), 6) AS media FROM {sc} GROUP BY model_version",
    # ST-01, FN-09
    "st01_days": "SELECT CAST(data AS STRING) AS data, CAST(year(data) AS INT) AS ano, CAST(quarter(data) AS INT) AS trimestre, CAST(month(data) AS INT) AS mes FROM (SELECT data FROM {fe} UNION SELECT t.data FROM {fc} f JOIN {te} t ON f.sk_tempo = t.sk_tempo UNION SELECT t.data FROM {fo} f JOIN {te} t ON f.sk_tempo = t.sk_tempo) d WHERE data IS NOT NULL",
    # ST-03
    "st03_padded": "SELECT 'contrato' AS tipo, ano, CAST(sum(valor_contrato) AS DECIMAL(18,2)) AS valor, CAST(NULL AS BIGINT) AS canceladas FROM {fc} GROUP BY ano UNION ALL SELECT 'ordem', ano, CAST(sum(valor) AS DECIMAL(18,2)), count(*) FILTER (WHERE flag_cancelada) FROM {fo} GROUP BY ano",
    # AG-20, AG-21, AG-22
    "ag20_forecast_quality": "SELECT round(avg(abs(r.pago - p.valor_previsto_p50)), 2) AS mae, round(avg(CASE WHEN r.pago BETWEEN p.valor_previsto_p10 AND p.valor_previsto_p90 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS cobertura, round(avg(greatest(r.pago - p.valor_previsto_p50, 0) * 0.5 + greatest(p.valor_previsto_p50 - r.pago, 0) * 0.5), 2) AS pinball50, count(*) AS n FROM (SELECT o.codigo, t.ano, t.trimestre, CAST(sum(f.valor) AS DOUBLE) AS pago FROM {fo} f JOIN {te} t ON f.sk_tempo = t.sk_tempo JOIN {og} o ON f.sk_orgao = o.sk_orgao WHERE NOT f.flag_cancelada GROUP BY o.codigo, t.ano, t.trimestre) r JOIN {pv} p ON p.codigo_orgao = r.codigo AND p.ano_previsto = r.ano AND p.trimestre_previsto = r.trimestre WHERE p.is_backtest AND p.valor_previsto_p10 IS NOT NULL AND p.valor_previsto_p50 IS NOT NULL AND p.valor_previsto_p90 IS NOT NULL",
    # SL-06, SL-07
    "sl06_best_quarter": "SELECT ano_previsto, trimestre_previsto, n FROM (SELECT ano_previsto, trimestre_previsto, count(DISTINCT codigo_orgao) AS n FROM {pv} WHERE NOT is_backtest GROUP BY ano_previsto, trimestre_previsto) x ORDER BY n DESC, ano_previsto DESC, trimestre_previsto DESC LIMIT 1",
    # WN-11
    "wn11_holdout": "SELECT count(*) AS linhas FROM {pv} p JOIN (SELECT max(ano_previsto * 10 + trimestre_previsto) AS m FROM {pv} WHERE is_backtest) x ON p.ano_previsto * 10 + p.trimestre_previsto = x.m WHERE p.is_backtest",
}
