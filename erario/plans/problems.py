"""Queries of the general data problems (2, 3, 4, 6) over the tables of a data directory, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.functions.keys import key_number, plain_key, plain_number
from erario.operators.compaction import Compacted, committed, compact
from erario.operators.heavykeys import heavy_keys, key_profile
from erario.operators.history import creditor_versions
from erario.operators.orphans import composite_number, orphans
from erario.session import drop_on_exit, shared_dir
from erario.tables import table

#: Share of the rows of a table above which a key counts as heavy.
HEAVY_SHARE = 0.03

METRICS = ["container", "cpu_percent", "mem_usage_bytes", "mem_limit_bytes", "mem_percent", "coletado_em"]
SESSIONS = ["evento", "usuario", "origem_ip", "sessao_pid", "timestamp_evento"]


def _compacted(spark: SparkSession, sf_dir: str) -> dict[str, Compacted]:
    """The committed rewrites of both tables, as a reader finds them."""
    root = f"{shared_dir(spark)}/compactado-{uuid.uuid4().hex}"
    drop_on_exit(spark, root)  # a query's rewrite is not kept
    for name, same in (("infra_metricas_containers", METRICS), ("sessoes_ssh", SESSIONS)):
        compact(table(spark, sf_dir, name), F.to_date("coletado_em"), "arquivo", "registro_id", same, name, root)
    return {name: committed(spark, f"{root}/{name}") for name in ("infra_metricas_containers", "sessoes_ssh")}


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tabela, registro_id): the rows that the compaction of either table left out as repeats."""
    parts = [c.repeats.select(F.lit(name).alias("tabela"), "registro_id") for name, c in _compacted(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1])


def p2_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tabela, dia, registros, antes, arquivos): records of each day in the rewrite, its files before and those now on disk."""
    out = []
    for name, c in _compacted(spark, sf_dir).items():
        old = table(spark, sf_dir, name).groupBy(F.to_date("coletado_em").alias("dia")).agg(F.countDistinct("arquivo").alias("antes"))
        new = c.report.groupBy("dia").agg(F.sum("rows").alias("registros"), F.sum("files").alias("arquivos"))
        out.append(new.join(old, new["dia"].eqNullSafe(old["dia"])).select(F.lit(name).alias("tabela"), F.date_format(new["dia"], "yyyy-MM-dd").alias("dia"), "registros", "antes", "arquivos"))
    return out[0].unionByName(out[1])


def _bodies(spark: SparkSession, sf_dir: str) -> list[tuple]:
    forecasts, orders = table(spark, sf_dir, "previsao_pagamento_orgao"), table(spark, sf_dir, "fato_ordem_bancaria")
    return [
        ("previsao_pagamento_orgao", forecasts, plain_number(F.col("codigo_orgao")), F.col("valor_previsto_p50"), ["scored_at", "ano_previsto", "trimestre_previsto"]),
        ("fato_ordem_bancaria", orders, plain_key(F.col("sk_orgao")), F.col("valor"), ["id_ob_origem", "ano"]),
    ]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tabela, chave): keys with more than 3 % of all rows of their table."""
    parts = [heavy_keys(df, key, order, HEAVY_SHARE).select(F.lit(name).alias("tabela"), "chave") for name, df, key, _, order in _bodies(spark, sf_dir)]
    return parts[0].unionByName(parts[1])


def p3_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tabela, chave, linhas, total, menor, maior) of each body; the rows without a key under chave null."""
    parts = [key_profile(df, key, value, order).select(F.lit(name).alias("tabela"), "chave", "linhas", *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("total", "menor", "maior")]) for name, df, key, value, order in _bodies(spark, sf_dir)]
    return parts[0].unionByName(parts[1])


def p4_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full history of each creditor: dimension and snapshots combined."""
    v = creditor_versions(table(spark, sf_dir, "dim_credor"), table(spark, sf_dir, "snapshot_credor"))
    return v.withColumn("valido_de", F.date_format("valido_de", "yyyy-MM-dd HH:mm:ss")).withColumn("valido_ate", F.date_format("valido_ate", "yyyy-MM-dd HH:mm:ss"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cnpj_cpf, valido_de): versions opened by a snapshot."""
    v = creditor_versions(table(spark, sf_dir, "dim_credor"), table(spark, sf_dir, "snapshot_credor"))
    return v.filter("aberta_por = 'snapshot'").select("cnpj_cpf", F.date_format("valido_de", "yyyy-MM-dd").alias("valido_de"))


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    contracts, scores = table(spark, sf_dir, "fato_contrato"), table(spark, sf_dir, "score_anomalia_contrato")
    never = F.lit(None).cast("timestamp_ntz")
    refs, parents = None, None
    for field, dim in (("sk_credor", "dim_credor"), ("sk_orgao", "dim_orgao")):
        k = plain_key(F.col(field))
        r = contracts.select(F.lit(field).alias("grupo"), k.alias("chave"), key_number(k).alias("numero"), F.col("carregado_em").alias("em"), F.lit("fato_contrato").alias("tabela"), "id_contrato_origem", "ano")
        p = table(spark, sf_dir, dim).select(F.lit(field).alias("grupo"), k.alias("chave"), key_number(k).alias("numero"), F.col("carregado_em").alias("de"), F.col("removido_em").alias("ate"))
        refs, parents = (r, p) if refs is None else (refs.unionByName(r), parents.unionByName(p))
    k = plain_number(F.col("id_contrato_origem"))
    pair = F.concat_ws("/", F.when(k.isNotNull(), F.col("ano")), k)
    pair = F.when(k.isNotNull() & F.col("ano").isNotNull(), pair)
    n = composite_number(F.col("ano"), k)
    refs = refs.unionByName(scores.select(F.lit("id_contrato_origem").alias("grupo"), pair.alias("chave"), n.alias("numero"), F.col("scored_at").alias("em"), F.lit("score_anomalia_contrato").alias("tabela"), "id_contrato_origem", "ano"))
    parents = parents.unionByName(contracts.select(F.lit("id_contrato_origem").alias("grupo"), pair.alias("chave"), n.alias("numero"), F.col("carregado_em").alias("de"), never.alias("ate")))
    return orphans(refs, parents)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tabela, campo, id_contrato_origem, ano): references for which no target row stood at their time."""
    return _orphans(spark, sf_dir).select("tabela", F.col("grupo").alias("campo"), plain_number(F.col("id_contrato_origem")).alias("id_contrato_origem"), "ano").distinct()


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tabela, campo, ano, motivo, linhas): referring rows without a target, by table and year."""
    return _orphans(spark, sf_dir).groupBy("tabela", F.col("grupo").alias("campo"), "ano", "motivo").agg(F.count("*").alias("linhas"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found, "p2_layout": p2_layout, "p3_found": p3_found, "p3_profile": p3_profile,
    "p4_found": p4_found, "p4_versions": p4_versions, "p6_found": p6_found, "p6_report": p6_report,
}

_REPEATS = """
  SELECT 'infra_metricas_containers' AS tabela, registro_id, CAST(coletado_em AS DATE) AS d, arquivo,
         row_number() OVER (PARTITION BY container, cpu_percent, mem_usage_bytes, mem_limit_bytes, mem_percent, coletado_em ORDER BY registro_id) AS n
  FROM infra_metricas_containers
  UNION ALL
  SELECT 'sessoes_ssh', registro_id, CAST(coletado_em AS DATE), arquivo,
         row_number() OVER (PARTITION BY evento, usuario, origem_ip, sessao_pid, timestamp_evento ORDER BY registro_id)
  FROM sessoes_ssh
"""
_KEYED = """
  SELECT 'previsao_pagamento_orgao' AS tabela, CASE WHEN trim(codigo_orgao) <> '' THEN regexp_replace(lower(trim(codigo_orgao)), '^0+(.)', '\\1') END AS chave, CAST(valor_previsto_p50 AS DECIMAL(18,2)) AS v
  FROM previsao_pagamento_orgao
  UNION ALL
  SELECT 'fato_ordem_bancaria', CASE WHEN trim(sk_orgao) <> '' THEN lower(trim(sk_orgao)) END, CAST(valor AS DECIMAL(18,2)) FROM fato_ordem_bancaria
"""
_BLANKS = "'^[\\s\u00a0]+|[\\s\u00a0]+$'"
_SEEN = f"""
  base AS (SELECT cnpj_cpf, nome, tipo, historico_infringement FROM (
      SELECT *, row_number() OVER (PARTITION BY cnpj_cpf ORDER BY valido_de DESC, carregado_em DESC) AS n FROM dim_credor WHERE versao_atual) WHERE n = 1),
  snap AS (SELECT cnpj_cpf, data_snapshot, nome, tipo, historico_infringement FROM (
      SELECT regexp_replace(cnpj_cpf, '[^0-9]', '', 'g') AS cnpj_cpf, data_snapshot, nome, tipo, historico_infringement,
             row_number() OVER (PARTITION BY regexp_replace(cnpj_cpf, '[^0-9]', '', 'g'), data_snapshot ORDER BY carregado_em DESC, nome DESC NULLS LAST, tipo DESC NULLS LAST, historico_infringement DESC NULLS LAST) AS n
      FROM snapshot_credor) WHERE n = 1),
  seen AS (SELECT cnpj_cpf, CAST(NULL AS DATE) AS em, upper(regexp_replace(nome, {_BLANKS}, '', 'g')) AS nome, tipo, historico_infringement FROM base
      UNION ALL SELECT cnpj_cpf, data_snapshot, upper(regexp_replace(nome, {_BLANKS}, '', 'g')), tipo, historico_infringement FROM snap),
  lagged AS (SELECT *, row_number() OVER w AS n, lag(nome) OVER w AS b_nome, lag(tipo) OVER w AS b_tipo, lag(historico_infringement) OVER w AS b_hist
      FROM seen WINDOW w AS (PARTITION BY cnpj_cpf ORDER BY em NULLS FIRST)),
  versions AS (SELECT * FROM lagged WHERE n = 1 OR nome IS DISTINCT FROM b_nome OR tipo IS DISTINCT FROM b_tipo OR historico_infringement IS DISTINCT FROM b_hist)
"""
_LOST = """
  refs AS (
    SELECT 'fato_contrato' AS tabela, 'sk_credor' AS campo, lower(trim(sk_credor)) AS k, carregado_em AS em, id_contrato_origem, ano FROM fato_contrato WHERE trim(sk_credor) <> ''
    UNION ALL SELECT 'fato_contrato', 'sk_orgao', lower(trim(sk_orgao)), carregado_em, id_contrato_origem, ano FROM fato_contrato WHERE trim(sk_orgao) <> ''
    UNION ALL SELECT 'score_anomalia_contrato', 'id_contrato_origem', ano || '/' || regexp_replace(trim(id_contrato_origem), '^0+(.)', '\\1'), scored_at, id_contrato_origem, ano
      FROM score_anomalia_contrato WHERE trim(id_contrato_origem) <> '' AND ano IS NOT NULL),
  parents AS (
    SELECT 'sk_credor' AS campo, lower(trim(sk_credor)) AS k, carregado_em AS de, removido_em AS ate FROM dim_credor
    UNION ALL SELECT 'sk_orgao', lower(trim(sk_orgao)), carregado_em, removido_em FROM dim_orgao
    UNION ALL SELECT 'id_contrato_origem', ano || '/' || regexp_replace(trim(id_contrato_origem), '^0+(.)', '\\1'), carregado_em, NULL FROM fato_contrato),
  lost AS (SELECT r.*, EXISTS (SELECT 1 FROM parents p WHERE p.campo = r.campo AND p.k = r.k) AS known FROM refs r
    WHERE NOT EXISTS (SELECT 1 FROM parents p WHERE p.campo = r.campo AND p.k = r.k AND p.de <= r.em AND (p.ate IS NULL OR p.ate > r.em)))
"""

SQL: dict[str, str] = {
    "p2_found": f"SELECT tabela, registro_id FROM ({_REPEATS}) WHERE n > 1",
    # a day's rows fit one file of the target size
    "p2_layout": f"SELECT tabela, strftime(d, '%Y-%m-%d') AS dia, count(*) FILTER (WHERE n = 1) AS registros, count(DISTINCT arquivo) AS antes, 1 AS arquivos FROM ({_REPEATS}) GROUP BY tabela, d HAVING count(*) FILTER (WHERE n = 1) > 0",
    "p3_found": f"SELECT tabela, chave FROM (SELECT tabela, chave, count(*) AS n, sum(count(*)) OVER (PARTITION BY tabela) AS t FROM ({_KEYED}) GROUP BY tabela, chave) WHERE chave IS NOT NULL AND n > {HEAVY_SHARE} * t",
    "p3_profile": f"SELECT tabela, chave, count(*) AS linhas, CAST(sum(v) AS DECIMAL(18,2)) AS total, CAST(min(v) AS DECIMAL(18,2)) AS menor, CAST(max(v) AS DECIMAL(18,2)) AS maior FROM ({_KEYED}) GROUP BY tabela, chave",
    "p4_found": f"WITH {_SEEN} SELECT cnpj_cpf, strftime(em, '%Y-%m-%d') AS valido_de FROM versions WHERE em IS NOT NULL",
    "p4_versions": f"""WITH {_SEEN},
  spans AS (SELECT *, lead(em) OVER (PARTITION BY cnpj_cpf ORDER BY em NULLS FIRST) AS ate FROM versions),
  cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cnpj_cpf ORDER BY valido_de DESC, carregado_em DESC, sk_credor DESC) AS n FROM dim_credor WHERE versao_atual) WHERE n = 1)
SELECT sk_credor, cnpj_cpf, nome, tipo, historico_infringement, strftime(valido_de, '%Y-%m-%d %H:%M:%S') AS valido_de, strftime(valido_ate, '%Y-%m-%d %H:%M:%S') AS valido_ate, versao_atual, 'dim_credor' AS aberta_por
FROM (SELECT DISTINCT sk_credor, cnpj_cpf, nome, tipo, historico_infringement, valido_de, valido_ate, versao_atual FROM dim_credor WHERE NOT versao_atual)
UNION ALL
SELECT c.sk_credor, c.cnpj_cpf, c.nome, c.tipo, c.historico_infringement, strftime(c.valido_de, '%Y-%m-%d %H:%M:%S'), strftime(CAST(s.ate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), s.ate IS NULL, 'dim_credor'
FROM cur c JOIN spans s ON s.cnpj_cpf = c.cnpj_cpf AND s.em IS NULL
UNION ALL
SELECT md5(cnpj_cpf || '||' || strftime(em, '%Y-%m-%d')), cnpj_cpf, nome, tipo, historico_infringement, strftime(CAST(em AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), strftime(CAST(ate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), ate IS NULL, 'snapshot'
FROM spans WHERE em IS NOT NULL""",
    "p6_found": f"WITH {_LOST} SELECT DISTINCT tabela, campo, regexp_replace(lower(trim(id_contrato_origem)), '^0+(.)', '\\1') AS id_contrato_origem, ano FROM lost",
    "p6_report": f"WITH {_LOST} SELECT tabela, campo, ano, CASE WHEN known THEN 'fora_do_prazo' ELSE 'inexistente' END AS motivo, count(*) AS linhas FROM lost GROUP BY ALL",
}
