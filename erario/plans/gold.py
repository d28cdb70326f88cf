"""Conformed frames of the spending model: facts with one row a key, dimensions, calendar."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.functions import rules
from erario.functions.keys import plain_key, plain_number
from erario.operators.lake import Lake
from erario.operators.relational import calendar, dedup
from erario.tables import table

#: Days that the calendar covers.
FIRST_DAY, LAST_DAY = "2019-01-01", "2029-12-31"


Wanted = Collection[str] | None


def _upper(df: DataFrame, column: str, text: Column) -> DataFrame:
    return df.withColumn(column, F.upper(text)) if column in df.columns else df


def contracts(spark: SparkSession, d: str, columns: Wanted = None) -> DataFrame:
    """Contracts, the row of each (id, ano) loaded last, with plain keys."""
    rows = table(spark, d, "fato_contrato").withColumn("id_contrato_origem", plain_number(F.col("id_contrato_origem"))).filter("id_contrato_origem is not null and ano is not null")
    for k in ("sk_credor", "sk_orgao", "sk_modalidade", "sk_tempo"):
        rows = rows.withColumn(k, plain_key(F.col(k)))
    one = dedup(rows, ["id_contrato_origem", "ano"], ["carregado_em", "num_spu", "sk_credor", "sk_orgao", "valor_contrato", "valor_pago", "status"], columns, tie=False)
    return _upper(one, "status", F.col("status"))


def bank_orders(spark: SparkSession, d: str, columns: Wanted = None) -> DataFrame:
    """Bank orders, the row of each (id, ano) loaded last, with plain keys."""
    rows = table(spark, d, "fato_ordem_bancaria").filter("id_ob_origem is not null and ano is not null").withColumn("sk_orgao", plain_key(F.col("sk_orgao"))).withColumn("sk_tempo", plain_key(F.col("sk_tempo")))
    one = dedup(rows, ["id_ob_origem", "ano"], ["carregado_em", "sk_orgao", "valor", "status", "natureza"], columns, tie=False)
    return _upper(one, "status", F.trim("status"))


def commitments(spark: SparkSession, d: str, columns: Wanted = None) -> DataFrame:
    """Commitments as typed rows: linha_id, ano, data, codigoug, codigocredor, cod_contrato, valor, modalidade."""
    e = table(spark, d, "empenhos")
    return e.select("linha_id", "ano", rules.as_day(F.col("dataemissao")).alias("data"), "codigoug", "codigocredor", F.col("codprocesso").alias("cod_contrato"), rules.money(F.col("valor")).alias("valor"), F.translate(F.upper("modalidade"), "Á", "A").alias("modalidade"))


def bodies(spark: SparkSession, d: str, columns: Wanted = None) -> DataFrame:
    """Public bodies, one row for each (codigo, ano): the one loaded last."""
    return dedup(table(spark, d, "dim_orgao").select("sk_orgao", "codigo", "ano", "nome", "sigla", "tipo_administracao", "carregado_em"), ["codigo", "ano"], ["carregado_em", "sk_orgao"], columns, tie=False)


def creditors(spark: SparkSession, d: str, columns: Wanted = None) -> DataFrame:
    """Versions of creditors, each once."""
    return dedup(table(spark, d, "dim_credor").select("sk_credor", "cnpj_cpf", "nome", "tipo", "historico_infringement", "valido_de", "valido_ate", "versao_atual", "carregado_em"), ["sk_credor"], ["carregado_em"], columns, tie=False)


def scores(spark: SparkSession, d: str, columns: Wanted = None) -> DataFrame:
    """Scores of contracts, the last one of each (id, ano)."""
    rows = table(spark, d, "score_anomalia_contrato").withColumn("id_contrato_origem", plain_number(F.col("id_contrato_origem"))).filter("id_contrato_origem is not null and ano is not null")
    return dedup(rows, ["id_contrato_origem", "ano"], ["scored_at", "score_anomalia"], columns, tie=False)


def forecasts(spark: SparkSession, d: str, columns: Wanted = None) -> DataFrame:
    """Forecasts, the last one of each body, quarter and kind."""
    rows = table(spark, d, "previsao_pagamento_orgao").withColumn("codigo_orgao", plain_number(F.col("codigo_orgao"))).filter("codigo_orgao is not null")
    return dedup(rows, ["codigo_orgao", "ano_previsto", "trimestre_previsto", "is_backtest"], ["scored_at", "valor_previsto_p50", "nome_orgao", "valor_previsto_p10", "valor_previsto_p90", "model_version"], columns, tie=False)


def days(spark: SparkSession, d: str, columns: Wanted = None) -> DataFrame:
    """Calendar."""
    return calendar(FIRST_DAY, LAST_DAY, spark)


FRAMES: dict[str, Callable[..., DataFrame]] = {"fc": contracts, "fo": bank_orders, "fe": commitments, "og": bodies, "cr": creditors, "sc": scores, "pv": forecasts, "te": days}
#: Stored tables: frame -> (name, partition columns).
STORED: dict[str, tuple[str, tuple[str, ...]]] = {
    "fc": ("fato_contrato", ("ano",)), "fo": ("fato_ordem_bancaria", ("ano",)), "fe": ("fato_empenho", ("ano",)), "og": ("dim_orgao", ()), "cr": ("dim_credor", ()),
    "sc": ("score_anomalia_contrato", ()), "pv": ("previsao_pagamento_orgao", ()), "te": ("dim_tempo", ()),
}


def build(spark: SparkSession, d: str, lake: Lake, now: Column | None = None, select: Collection[str] | None = None) -> dict[str, int]:
    """Rebuild the stored tables from the data directory ``d``: {name: rows}.

    Each table is replaced as a whole and stamped ``gerado_em`` with ``now``; facts are partitioned by ano, so later
    readers need neither the raw tables nor another deduplication. select: only these frames or table names.
    """
    out = {}
    for frame, (name, parts) in STORED.items():
        if select is None or frame in select or name in select:
            out[name] = lake.replace(f"gold.{name}", FRAMES[frame](spark, d).withColumn("gerado_em", F.current_timestamp() if now is None else now), parts, "build")
    return out


def stored(lake: Lake) -> dict[str, Callable[..., DataFrame]]:
    """The frames over stored tables, in place of FRAMES; Catalyst prunes their columns down to the scan."""
    return {frame: (lambda spark, d, columns=None, name=name: lake.read(f"gold.{name}").drop("gerado_em")) for frame, (name, _) in STORED.items()}


_PLAIN_NUMBER = "regexp_replace(lower(trim({c})), '^0+(.)', '\\1')"
_ID = _PLAIN_NUMBER.format(c="id_contrato_origem")
_KEY = "CASE WHEN trim({c}) <> '' THEN lower(trim({c})) END"

#: The same frames as SQL.
SQL: dict[str, str] = {
    "fc": f"""fc AS (SELECT * EXCLUDE (rn, status), upper(status) AS status FROM (
        SELECT *, row_number() OVER (PARTITION BY id_contrato_origem, ano ORDER BY carregado_em DESC NULLS LAST, num_spu DESC NULLS LAST, sk_credor DESC NULLS LAST, sk_orgao DESC NULLS LAST, valor_contrato DESC NULLS LAST, valor_pago DESC NULLS LAST, status DESC NULLS LAST) AS rn
        FROM (SELECT * REPLACE ({_ID} AS id_contrato_origem, {", ".join(_KEY.format(c=c) + f" AS {c}" for c in ("sk_credor", "sk_orgao", "sk_modalidade", "sk_tempo"))}) FROM fato_contrato WHERE trim(id_contrato_origem) <> '' AND ano IS NOT NULL)) WHERE rn = 1)""",
    "fo": f"""fo AS (SELECT * EXCLUDE (rn, status), upper(trim(status)) AS status FROM (
        SELECT *, row_number() OVER (PARTITION BY id_ob_origem, ano ORDER BY carregado_em DESC NULLS LAST, sk_orgao DESC NULLS LAST, valor DESC NULLS LAST, status DESC NULLS LAST, natureza DESC NULLS LAST) AS rn
        FROM (SELECT * REPLACE ({_KEY.format(c="sk_orgao")} AS sk_orgao, {_KEY.format(c="sk_tempo")} AS sk_tempo) FROM fato_ordem_bancaria WHERE id_ob_origem IS NOT NULL AND ano IS NOT NULL)) WHERE rn = 1)""",
    "fe": """fe AS (SELECT linha_id, ano, CASE WHEN regexp_matches(dataemissao, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$') THEN CAST(try_strptime(dataemissao, '%d/%m/%Y') AS DATE) ELSE try_cast(substr(dataemissao, 1, 10) AS DATE) END AS data,
        codigoug, codigocredor, codprocesso AS cod_contrato, try_cast(valor AS DECIMAL(15,2)) AS valor, replace(upper(modalidade), 'Á', 'A') AS modalidade FROM empenhos)""",
    "og": "og AS (SELECT sk_orgao, codigo, ano, nome, sigla, tipo_administracao, carregado_em FROM (SELECT *, row_number() OVER (PARTITION BY codigo, ano ORDER BY carregado_em DESC NULLS LAST, sk_orgao DESC) AS rn FROM dim_orgao) WHERE rn = 1)",
    "cr": "cr AS (SELECT sk_credor, cnpj_cpf, nome, tipo, historico_infringement, valido_de, valido_ate, versao_atual, carregado_em FROM (SELECT *, row_number() OVER (PARTITION BY sk_credor ORDER BY carregado_em DESC NULLS LAST) AS rn FROM dim_credor) WHERE rn = 1)",
    "sc": f"""sc AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_contrato_origem, ano ORDER BY scored_at DESC NULLS LAST, score_anomalia DESC NULLS LAST) AS rn
        FROM (SELECT * REPLACE ({_ID} AS id_contrato_origem) FROM score_anomalia_contrato WHERE trim(id_contrato_origem) <> '' AND ano IS NOT NULL)) WHERE rn = 1)""",
    "pv": f"""pv AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY codigo_orgao, ano_previsto, trimestre_previsto, is_backtest ORDER BY scored_at DESC NULLS LAST, valor_previsto_p50 DESC NULLS LAST, nome_orgao DESC NULLS LAST, valor_previsto_p10 DESC NULLS LAST, valor_previsto_p90 DESC NULLS LAST, model_version DESC NULLS LAST) AS rn
        FROM (SELECT * REPLACE ({_PLAIN_NUMBER.format(c="codigo_orgao")} AS codigo_orgao) FROM previsao_pagamento_orgao WHERE trim(codigo_orgao) <> '')) WHERE rn = 1)""",
    "te": f"""te AS (SELECT md5(strftime(data, '%Y-%m-%d')) AS sk_tempo, data, CAST(year(data) AS INTEGER) AS ano, CAST(quarter(data) AS INTEGER) AS trimestre, CAST(month(data) AS INTEGER) AS mes, CAST(isodow(data) AS INTEGER) AS dia_semana
        FROM (SELECT CAST(unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS DATE) AS data))""",
}
