"""Queries of the composite operators over the test tables, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from erario.functions import rules
from erario.functions.keys import plain_key, surrogate_key
from erario.operators import quality
from erario.operators import relational as rel
from erario.plans import gold, serve
from erario.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(body: str | None = None, *frames: str):
    """Registers a query under its function's name; ``body`` is its SQL, over the named frames and the raw tables."""

    def add(f):
        QUERIES[f.__name__] = f
        if body is not None:
            ctes = ", ".join(gold.SQL[n] for n in frames)
            SQL[f.__name__] = (f"WITH {ctes} " if frames and not body.startswith(",") else f"WITH {ctes}" if frames else "") + body
        return f

    return add


def _with_day(facts: DataFrame, days: DataFrame, how: str = "inner") -> DataFrame:
    """Facts with their calendar columns (fixed size, broadcast)."""
    d = days.select("sk_tempo", "data", F.col("ano").alias("t_ano"), "trimestre", "mes")
    return facts.join(F.broadcast(d), "sk_tempo", how)


# OP-DEDUP, WN-01 … WN-05, PRJ-02
@query("SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, CAST(l_extendedprice AS DECIMAL(15,2)) AS preco FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) AS rn FROM lineitem) WHERE rn = 1")
def op_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")
    one = rel.dedup(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice", "l_partkey"])
    return one.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"), F.col("l_extendedprice").cast("decimal(15,2)").alias("preco"))


# OP-MERGE, SNK-06, JN-10
@query("SELECT id_ob_origem, ano, valor, status, strftime(carregado_em, '%Y-%m-%d %H:%M:%S') AS carregado_em FROM fo", "fo")
def op_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fato_ordem_bancaria").filter("id_ob_origem is not null and ano is not null").withColumn("sk_orgao", plain_key(F.col("sk_orgao")))
    cut = F.lit("2024-01-01").cast("timestamp_ntz")
    order = ["carregado_em", "sk_orgao", "valor", "status", "natureza"]
    old, new = (rel.dedup(rows.filter(c), ["id_ob_origem", "ano"], order) for c in (F.col("carregado_em") < cut, F.col("carregado_em") >= cut))
    merged = rel.merge(old, new, ["id_ob_origem", "ano"], "carregado_em")
    merged = rel.merge(merged, old, ["id_ob_origem", "ano"], "carregado_em")  # a replay of the older batch changes nothing
    return merged.select("id_ob_origem", "ano", "valor", F.upper(F.trim("status")).alias("status"), F.date_format("carregado_em", "yyyy-MM-dd HH:mm:ss").alias("carregado_em"))


# OP-ASOF, JN-03, WN-06
@query("""SELECT linha_id, sk_credor FROM (SELECT e.linha_id, c.sk_credor, row_number() OVER (PARTITION BY e.linha_id ORDER BY CASE WHEN CAST(c.valido_de AS DATE) <= e.data AND (c.valido_ate IS NULL OR e.data < CAST(c.valido_ate AS DATE)) THEN 0 ELSE 1 END, c.valido_de, c.valido_ate NULLS FIRST, c.sk_credor) AS rn
FROM fe e LEFT JOIN cr c ON e.codigocredor = c.cnpj_cpf) WHERE rn = 1""", "fe", "cr")  # fmt: skip
def op_asof(spark: SparkSession, d: str) -> DataFrame:
    e = gold.commitments(spark, d).select("linha_id", "codigocredor", "data")
    return rel.asof_version(e, "codigocredor", "data", gold.creditors(spark, d), "cnpj_cpf", "valido_de", "valido_ate", ["sk_credor"]).select("linha_id", "sk_credor")


# OP-OVERLAP, JN-09, FN-11
@query("""WITH spans AS (SELECT c.c_nationkey AS pais, CAST(o.o_orderdate AS DATE) AS inicio, (SELECT max(CAST(l.l_shipdate AS DATE)) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS fim, CAST(o.o_totalprice AS DECIMAL(18,2)) AS valor FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
  quarters AS (SELECT DISTINCT pais, CAST(year(inicio) AS INTEGER) AS ano, CAST(quarter(inicio) AS INTEGER) AS trimestre FROM spans),
  bounded AS (SELECT *, make_date(ano, (trimestre - 1) * 3 + 1, 1) AS a, CAST(make_date(ano, (trimestre - 1) * 3 + 1, 1) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS b FROM quarters)
SELECT q.pais, q.ano, q.trimestre, coalesce(CAST(sum(s.valor) AS DOUBLE), 0.0) AS ativo FROM bounded q LEFT JOIN spans s ON s.pais = q.pais AND (s.inicio IS NULL OR s.inicio <= q.b) AND (s.fim IS NULL OR s.fim >= q.a) GROUP BY q.pais, q.ano, q.trimestre""")
def op_overlap(spark: SparkSession, d: str) -> DataFrame:
    ends = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max(F.col("l_shipdate").cast("date")).alias("fim"))
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(ends, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    spans = o.select(F.col("c_nationkey").alias("pais"), F.col("o_orderdate").cast("date").alias("inicio"), "fim", F.col("o_totalprice").cast("decimal(18,2)").alias("valor"))
    q = spans.select("pais", F.year("inicio").alias("ano"), F.quarter("inicio").alias("trimestre")).distinct()
    a, b = rules.quarter_bounds(F.col("ano"), F.col("trimestre"))
    return rel.overlap_sum(q.withColumn("a", a).withColumn("b", b), ["pais"], "a", "b", spans, "inicio", "fim", "valor", "ativo").select("pais", "ano", "trimestre", "ativo")


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    f = _with_day(gold.contracts(spark, d), gold.days(spark, d))
    return f.groupBy(F.col("t_ano").alias("ano"), "mes").agg(F.count("*").alias("n"), F.sum("valor_pago").cast("decimal(18,2)").alias("pago"), F.sum("valor_empenhado").cast("decimal(18,2)").alias("empenhado"))


_MONTHLY = """, m AS (SELECT t.ano, t.mes, count(*) AS n, CAST(sum(valor_pago) AS DECIMAL(18,2)) AS pago, CAST(sum(valor_empenhado) AS DECIMAL(18,2)) AS empenhado FROM fc f JOIN te t ON f.sk_tempo = t.sk_tempo GROUP BY t.ano, t.mes),
  cut AS (SELECT * FROM (SELECT *, max(CASE WHEN n >= (SELECT quantile_cont(n, 0.5) * 0.5 FROM m) THEN 1 ELSE 0 END) OVER (ORDER BY ano DESC, mes DESC ROWS UNBOUNDED PRECEDING) AS seen, row_number() OVER (ORDER BY ano, mes) AS k FROM m) WHERE seen = 1 OR k = 1) """


# Q-05, WN-12, PRJ-11, FN-21
@query(_MONTHLY + "SELECT ano || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS rotulo, 'pago' AS tipo, pago AS valor FROM cut UNION ALL SELECT ano || '-' || lpad(CAST(mes AS VARCHAR), 2, '0'), 'empenhado', empenhado FROM cut", "fc", "te")
def q05_monthly(spark: SparkSession, d: str) -> DataFrame:
    cut = rel.tail_cut(_monthly(spark, d), ["ano", "mes"], "n").select(rules.month_label(F.col("ano"), F.col("mes")).alias("rotulo"), "pago", "empenhado")
    return cut.unpivot(["rotulo"], ["pago", "empenhado"], "tipo", "valor")


# Q-07
@query(_MONTHLY + "SELECT t.ano, t.mes, o.codigo, CAST(sum(f.valor_pago) AS DECIMAL(18,2)) AS pago FROM fc f JOIN te t ON f.sk_tempo = t.sk_tempo JOIN og o ON f.sk_orgao = o.sk_orgao JOIN cut c ON c.ano = t.ano AND c.mes = t.mes GROUP BY t.ano, t.mes, o.codigo", "fc", "te", "og")
def q07_body_monthly(spark: SparkSession, d: str) -> DataFrame:
    keep = rel.tail_cut(_monthly(spark, d), ["ano", "mes"], "n").select("ano", "mes")
    f = _with_day(gold.contracts(spark, d), gold.days(spark, d)).drop("ano").withColumnRenamed("t_ano", "ano")
    f = rel.lookup(f, gold.bodies(spark, d).select("sk_orgao", "codigo"), ["sk_orgao"]).filter("codigo is not null")
    return f.join(F.broadcast(keep), ["ano", "mes"]).groupBy("ano", "mes", "codigo").agg(F.sum("valor_pago").cast("decimal(18,2)").alias("pago"))


# Q-02, AG-10
@query("SELECT round(coalesce(quantile_disc(score_anomalia, 0.9), 0.7), 6) AS corte FROM sc", "sc")
def q02_cutoff(spark: SparkSession, d: str) -> DataFrame:
    return gold.scores(spark, d).agg(F.round(F.coalesce(F.percentile_approx("score_anomalia", 0.9, 1_000_000), F.lit(0.7)), 6).alias("corte"))


# Q-09, AG-17, FN-20
@query("SELECT faixa, CAST(round(faixa * 0.05, 6) AS DOUBLE) AS inicio, CAST(round((faixa + 0.5) * 0.05, 6) AS DOUBLE) AS centro, linhas, CASE WHEN (faixa + 0.5) * 0.05 < 0.70 THEN 'Baixo' WHEN (faixa + 0.5) * 0.05 <= 0.85 THEN 'Médio' ELSE 'Alto' END AS risco FROM (SELECT CAST(least(floor(round(round(score_anomalia, 6) / 0.05, 6)), 19) AS INTEGER) AS faixa, count(*) AS linhas FROM sc WHERE score_anomalia BETWEEN 0 AND 1 GROUP BY 1) WHERE (faixa + 0.5) * 0.05 >= 0.49", "sc")
def q09_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rel.histogram(gold.scores(spark, d), "score_anomalia", 20).filter("centro >= 0.49").withColumn("risco", rules.risk_class(F.col("centro")))


# AG-11
@query("SELECT round(quantile_cont(score_anomalia, 0.5), 4) AS p50, round(quantile_cont(score_anomalia, 0.75), 4) AS p75, round(quantile_cont(score_anomalia, 0.9), 4) AS p90, round(quantile_cont(score_anomalia, 0.95), 4) AS p95, round(quantile_cont(score_anomalia, 0.99), 4) AS p99 FROM sc", "sc")
def ag11_quantiles(spark: SparkSession, d: str) -> DataFrame:
    q = gold.scores(spark, d).agg(F.percentile("score_anomalia", F.array(*[F.lit(x) for x in (0.5, 0.75, 0.9, 0.95, 0.99)])).alias("q"))
    return q.select(*[F.round(F.get("q", i), 4).alias(n) for i, n in enumerate(("p50", "p75", "p90", "p95", "p99"))])


# AG-13
@query("SELECT ano, round(sum(coalesce(CAST(valor_ajuste AS DOUBLE), (SELECT quantile_cont(CAST(valor_ajuste AS DOUBLE), 0.5) FROM fc))), 2) AS ajuste FROM fc GROUP BY ano", "fc")
def ag13_imputed(spark: SparkSession, d: str) -> DataFrame:
    f = gold.contracts(spark, d).withColumn("x", F.col("valor_ajuste").cast("double"))
    m = f.agg(F.percentile("x", 0.5).alias("m"))
    return f.crossJoin(F.broadcast(m)).groupBy("ano").agg(F.round(F.sum(F.coalesce("x", "m")), 2).alias("ajuste"))


# AG-14, JN-13
@query("SELECT sk_orgao, natureza FROM (SELECT sk_orgao, natureza, row_number() OVER (PARTITION BY sk_orgao ORDER BY count(*) DESC, natureza) AS rn FROM fo WHERE natureza IS NOT NULL AND sk_orgao IS NOT NULL GROUP BY sk_orgao, natureza) WHERE rn = 1", "fo")
def ag14_mode(spark: SparkSession, d: str) -> DataFrame:
    return rel.mode_per_group(gold.bank_orders(spark, d).filter("sk_orgao is not null"), ["sk_orgao"], "natureza")


# AG-27
@query("SELECT CAST(floor(round((CAST(valor_contrato AS DOUBLE) - lo) / (hi - lo), 9) * 10) AS INTEGER) AS decil, count(*) AS linhas FROM fc, (SELECT CAST(min(valor_contrato) AS DOUBLE) AS lo, CAST(max(valor_contrato) AS DOUBLE) AS hi FROM fc) WHERE valor_contrato IS NOT NULL GROUP BY 1", "fc")
def ag27_scaled(spark: SparkSession, d: str) -> DataFrame:
    f = gold.contracts(spark, d).select(F.col("valor_contrato").cast("double").alias("v")).filter("v is not null")
    return rel.min_max(f, "v", "s").groupBy(F.floor(F.round("s", 9) * 10).cast("int").alias("decil")).agg(F.count("*").alias("linhas"))


# PRJ-12
@query("SELECT ano, CAST(sum(CASE WHEN natureza = '339039' THEN 1 ELSE 0 END) AS BIGINT) AS nat_339039, CAST(sum(CASE WHEN natureza = '449051' THEN 1 ELSE 0 END) AS BIGINT) AS nat_449051 FROM fo GROUP BY ano", "fo")
def prj12_one_hot(spark: SparkSession, d: str) -> DataFrame:
    hot = rel.one_hot(gold.bank_orders(spark, d).select("ano", "natureza"), "natureza", ["339039", "449051"], "nat")
    return hot.groupBy("ano").agg(F.sum("nat_339039").alias("nat_339039"), F.sum("nat_449051").alias("nat_449051"))


# JN-05, AG-06
@query("SELECT sk_credor, cnpj_cpf, bool_or(historico_infringement) OVER (PARTITION BY cnpj_cpf) AS algum FROM cr", "cr")
def jn05_any(spark: SparkSession, d: str) -> DataFrame:
    return gold.creditors(spark, d).select("sk_credor", "cnpj_cpf", F.bool_or("historico_infringement").over(Window.partitionBy("cnpj_cpf")).alias("algum"))


# JN-06, OP-RECON (raw side)
@query("SELECT coalesce(a.carga_id, b.carga_id) AS carga_id, a.registros, b.linhas, coalesce(a.registros, 0) - coalesce(b.linhas, 0) AS diferenca, round(100.0 * CAST(b.linhas AS DOUBLE) / nullif(CAST(a.registros AS DOUBLE), 0), 3) AS pct FROM (SELECT carga_id, max(registros) AS registros FROM bronze_ingestao WHERE lower(fonte) = 'empenhos' GROUP BY 1) a FULL OUTER JOIN (SELECT carga_id, count(*) AS linhas FROM empenhos GROUP BY 1) b ON a.carga_id = b.carga_id")
def jn06_load_counts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "bronze_ingestao").filter(F.lower("fonte") == "empenhos").groupBy("carga_id").agg(F.max("registros").alias("registros"))
    return quality.reconcile_counts(a, table(spark, d, "empenhos").groupBy("carga_id").agg(F.count("*").alias("linhas")), "carga_id", "registros", "linhas")


# JN-10
@query("SELECT a.modalidade, count(*) AS linhas FROM fe a JOIN (SELECT DISTINCT modalidade FROM fe) b ON a.modalidade IS NOT DISTINCT FROM b.modalidade GROUP BY 1", "fe")
def jn10_null_safe(spark: SparkSession, d: str) -> DataFrame:
    e = gold.commitments(spark, d).select("modalidade")
    b = e.distinct().withColumnRenamed("modalidade", "m")  # few values: fixed list of modalities
    return e.join(b, e["modalidade"].eqNullSafe(b["m"])).groupBy("modalidade").agg(F.count("*").alias("linhas"))


# JN-12
@query("SELECT t.modalidade, t.total, coalesce(g.grandes, 0) AS grandes FROM (SELECT modalidade, count(*) AS total FROM fe GROUP BY 1) t LEFT JOIN (SELECT modalidade, count(*) AS grandes FROM fe WHERE valor > 100000 GROUP BY 1) g ON t.modalidade = g.modalidade", "fe")
def jn12_filled(spark: SparkSession, d: str) -> DataFrame:
    e = gold.commitments(spark, d)
    t = e.groupBy("modalidade").agg(F.count("*").alias("total"))
    return t.join(e.filter("valor > 100000").groupBy("modalidade").agg(F.count("*").alias("grandes")), "modalidade", "left").fillna(0, ["grandes"])


# JN-15
@query("SELECT id_contrato_origem, ano, sk_credor FROM fc f WHERE sk_credor IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cr c WHERE c.sk_credor = f.sk_credor)", "fc", "cr")
def jn15_orphans(spark: SparkSession, d: str) -> DataFrame:
    return quality.related(gold.contracts(spark, d), "sk_credor", gold.creditors(spark, d), "sk_credor").select("id_contrato_origem", "ano", "sk_credor")


# JN-16
@query("SELECT coalesce(r.trimestre, p.trimestre) AS trimestre, r.pago, p.previsto FROM (SELECT t.trimestre, CAST(sum(f.valor) AS DECIMAL(18,2)) AS pago FROM fo f JOIN te t ON f.sk_tempo = t.sk_tempo WHERE t.ano = 2026 AND NOT f.flag_cancelada GROUP BY 1) r FULL OUTER JOIN (SELECT trimestre_previsto AS trimestre, round(sum(valor_previsto_p50), 2) AS previsto FROM pv WHERE ano_previsto = 2026 AND NOT is_backtest GROUP BY 1) p ON r.trimestre = p.trimestre", "fo", "te", "pv")
def jn16_aligned(spark: SparkSession, d: str) -> DataFrame:
    r = _with_day(gold.bank_orders(spark, d), gold.days(spark, d)).filter("t_ano = 2026 and not flag_cancelada").groupBy("trimestre").agg(F.sum("valor").cast("decimal(18,2)").alias("pago"))
    p = gold.forecasts(spark, d).filter("ano_previsto = 2026 and not is_backtest").groupBy(F.col("trimestre_previsto").alias("trimestre")).agg(F.round(F.sum("valor_previsto_p50"), 2).alias("previsto"))
    return r.join(p, "trimestre", "full_outer")


_QUARTERS = """, q AS (SELECT o.codigo, t.ano, t.trimestre, CAST(sum(f.valor) AS DECIMAL(18,2)) AS pago FROM fo f JOIN te t ON f.sk_tempo = t.sk_tempo JOIN og o ON f.sk_orgao = o.sk_orgao WHERE NOT f.flag_cancelada GROUP BY 1, 2, 3),
  n AS (SELECT o.codigo, t.ano, t.trimestre, CASE WHEN f.natureza IN (SELECT natureza FROM (SELECT natureza FROM fo WHERE natureza IS NOT NULL AND NOT flag_cancelada GROUP BY 1 ORDER BY count(*) DESC, natureza LIMIT 8)) THEN f.natureza ELSE 'OUTROS' END AS natureza, count(*) AS c FROM fo f JOIN te t ON f.sk_tempo = t.sk_tempo JOIN og o ON f.sk_orgao = o.sk_orgao WHERE NOT f.flag_cancelada GROUP BY 1, 2, 3, 4),
  k AS (SELECT codigo, ano, trimestre, natureza FROM (SELECT *, row_number() OVER (PARTITION BY codigo, ano, trimestre ORDER BY c DESC, natureza) AS rn FROM n) WHERE rn = 1),
  s AS (SELECT o.codigo, t.data AS inicio, CASE WHEN f.status = 'VIGENTE' THEN NULL ELSE t.data + 365 END AS fim, CAST(f.valor_contrato AS DECIMAL(18,2)) AS v FROM fc f JOIN te t ON f.sk_tempo = t.sk_tempo JOIN og o ON f.sk_orgao = o.sk_orgao),
  a AS (SELECT q.codigo, q.ano, q.trimestre, coalesce(CAST(sum(s.v) AS DOUBLE), 0.0) AS ativo FROM q LEFT JOIN s ON s.codigo = q.codigo AND s.inicio <= CAST(make_date(q.ano, (q.trimestre - 1) * 3 + 1, 1) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AND (s.fim IS NULL OR s.fim >= make_date(q.ano, (q.trimestre - 1) * 3 + 1, 1)) GROUP BY 1, 2, 3) """


def panel(orders: DataFrame, contracts: DataFrame, bodies: DataFrame, days: DataFrame) -> DataFrame:
    """Quarterly panel: codigo, ano, trimestre, pago, natureza (dominant), ativo, lag_1, lag_4, alvo, eleicao.

    Lags and target go by rows of a body, gaps in its quarters are not filled. The panel is far smaller than the facts:
    all windows run after the aggregation.
    """
    codes = bodies.select("sk_orgao", "codigo")
    f = rel.lookup(_with_day(orders.filter(~F.col("flag_cancelada")), days).drop("ano").withColumnRenamed("t_ano", "ano"), codes, ["sk_orgao"]).filter("codigo is not null")
    keys = ["codigo", "ano", "trimestre"]
    top = orders.filter("not flag_cancelada and natureza is not null").groupBy("natureza").agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), "natureza").limit(8).select(F.col("natureza").alias("__t"))
    named = f.join(F.broadcast(top), F.col("natureza") == F.col("__t"), "left").withColumn("natureza", F.coalesce("__t", F.lit("OUTROS")))
    paid = f.groupBy(*keys).agg(F.sum("valor").cast("decimal(18,2)").alias("pago"))
    a, b = rules.quarter_bounds(F.col("ano"), F.col("trimestre"))
    spans = rel.lookup(_with_day(contracts, days), codes, ["sk_orgao"]).filter("codigo is not null").select("codigo", F.col("data").alias("inicio"), F.when(F.col("status").eqNullSafe("VIGENTE"), F.lit(None)).otherwise(F.date_add("data", 365)).alias("fim"), "valor_contrato")
    p = rel.overlap_sum(paid.withColumn("__a", a).withColumn("__b", b), ["codigo"], "__a", "__b", spans, "inicio", "fim", "valor_contrato", "ativo").drop("__a", "__b")
    p = p.join(rel.mode_per_group(named, keys, "natureza"), keys, "left")
    w = Window.partitionBy("codigo").orderBy("ano", "trimestre")
    return p.select(*keys, "pago", "natureza", "ativo", F.lag("pago", 1).over(w).alias("lag_1"), F.lag("pago", 4).over(w).alias("lag_4"), F.lead("pago", 1).over(w).alias("alvo"), rules.election_flag(F.col("ano"), F.col("trimestre")).alias("eleicao"))


# OP-PANEL, WN-07, WN-08, FN-11
@query(_QUARTERS + "SELECT q.codigo, q.ano, q.trimestre, q.pago, k.natureza, a.ativo, lag(q.pago, 1) OVER w AS lag_1, lag(q.pago, 4) OVER w AS lag_4, lead(q.pago, 1) OVER w AS alvo, CASE WHEN (CASE WHEN q.trimestre = 4 THEN q.ano + 1 ELSE q.ano END) % 2 = 0 THEN 1 ELSE 0 END AS eleicao FROM q JOIN k USING (codigo, ano, trimestre) JOIN a USING (codigo, ano, trimestre) WINDOW w AS (PARTITION BY q.codigo ORDER BY q.ano, q.trimestre)", "fo", "te", "og", "fc")
def op_panel(spark: SparkSession, d: str) -> DataFrame:
    return panel(gold.bank_orders(spark, d), gold.contracts(spark, d), gold.bodies(spark, d), gold.days(spark, d))


def _feature_rows(spark: SparkSession, d: str) -> DataFrame:
    return gold.contracts(spark, d).select("id_contrato_origem", "ano", F.col("valor_contrato").cast("double").alias("valor"), F.coalesce("flag_emergency", F.lit(False)).cast("int").alias("emergencia"), F.coalesce("status", F.lit("DESCONHECIDA")).alias("status"))


# OP-FEAT
@query("SELECT id_contrato_origem, ano, coalesce(CAST(valor_contrato AS DOUBLE), (SELECT quantile_cont(CAST(valor_contrato AS DOUBLE), 0.5) FROM fc)) AS valor, CAST(coalesce(flag_emergency, false) AS INTEGER) AS emergencia, CASE WHEN status = 'VIGENTE' THEN 1 ELSE 0 END AS status_VIGENTE, CASE WHEN status = 'ENCERRADO' THEN 1 ELSE 0 END AS status_ENCERRADO, CASE WHEN status = 'RESCINDIDO' THEN 1 ELSE 0 END AS status_RESCINDIDO FROM fc", "fc")
def op_features(spark: SparkSession, d: str) -> DataFrame:
    f = _feature_rows(spark, d)
    m = f.agg(F.percentile("valor", 0.5).alias("__m"))
    f = f.crossJoin(F.broadcast(m)).withColumn("valor", F.coalesce("valor", "__m")).drop("__m")
    return rel.one_hot(f, "status", ["VIGENTE", "ENCERRADO", "RESCINDIDO"], "status").drop("status")


# OP-RECON, AG-19
@query("""SELECT 'contratos' AS tabela, (SELECT count(*) FROM fato_contrato) AS brutas, count(*) AS unicas, count(o.sk_orgao) AS com_orgao, round(100.0 * CAST(count(o.sk_orgao) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0), 3) AS pct_orgao FROM fc f LEFT JOIN og o ON f.sk_orgao = o.sk_orgao
UNION ALL SELECT 'ordens', (SELECT count(*) FROM fato_ordem_bancaria), count(*), count(o.sk_orgao), round(100.0 * CAST(count(o.sk_orgao) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0), 3) FROM fo f LEFT JOIN og o ON f.sk_orgao = o.sk_orgao""", "fc", "fo", "og")
def op_recon(spark: SparkSession, d: str) -> DataFrame:
    codes = gold.bodies(spark, d).select("sk_orgao", "codigo")
    out = None
    for name, raw, facts in (("contratos", "fato_contrato", gold.contracts(spark, d)), ("ordens", "fato_ordem_bancaria", gold.bank_orders(spark, d))):
        n = table(spark, d, raw).agg(F.count("*").alias("brutas"))
        u = rel.lookup(facts.select("sk_orgao"), codes, ["sk_orgao"]).agg(F.count("*").alias("unicas"), F.count("codigo").alias("com_orgao"))
        one = n.crossJoin(u).select(F.lit(name).alias("tabela"), "brutas", "unicas", "com_orgao", rel.share(F.col("com_orgao"), F.col("unicas")).alias("pct_orgao"))  # two frames of one row each
        out = one if out is None else out.unionByName(one)
    return out


def checks(spark: SparkSession, d: str) -> list[quality.Check]:
    """The data tests of the model."""
    fc, fo, cr, sc = (gold.FRAMES[n](spark, d) for n in ("fc", "fo", "cr", "sc"))
    raw = {t: table(spark, d, t) for t in ("fato_contrato", "fato_ordem_bancaria", "dim_orgao", "score_anomalia_contrato")}
    load = table(spark, d, "bronze_ingestao")
    return [
        quality.Check("contrato_chave_unica", "warn", quality.unique(raw["fato_contrato"], ["id_contrato_origem", "ano"])),
        quality.Check("ordem_chave_unica", "warn", quality.unique(raw["fato_ordem_bancaria"], ["id_ob_origem", "ano"])),
        quality.Check("orgao_chave_unica", "warn", quality.unique(raw["dim_orgao"], ["codigo", "ano"])),
        quality.Check("score_chave_unica", "warn", quality.unique(raw["score_anomalia_contrato"], ["id_contrato_origem", "ano"])),
        quality.Check("ingestao_chave_unica", "warn", quality.unique(load, ["carga_id"])),
        quality.Check("contrato_sem_orgao", "warn", quality.not_null(fc, "sk_orgao")),
        quality.Check("credor_sem_tipo", "warn", quality.not_null(cr, "tipo")),
        quality.Check("credor_tipo_aceito", "warn", quality.accepted(cr, "tipo", ["PF", "PJ"])),
        quality.Check("contrato_credor_existe", "warn", quality.related(fc, "sk_credor", cr, "sk_credor")),
        quality.Check("contrato_valor_nao_negativo", "warn", quality.at_least(fc, F.col("valor_contrato"), 0)),
        quality.Check("ordem_valor_nao_negativo", "warn", quality.at_least(fo, F.col("valor"), 0)),
        quality.Check("score_no_intervalo", "error", sc.filter("score_anomalia < 0 or score_anomalia > 1")),
    ]


# OP-DQ, AG-16, AG-29, PRJ-05
@query("""SELECT 'contrato_chave_unica' AS teste, 'warn' AS severidade, (SELECT count(*) FROM (SELECT 1 FROM fato_contrato WHERE id_contrato_origem IS NOT NULL AND ano IS NOT NULL GROUP BY id_contrato_origem, ano HAVING count(*) > 1)) AS violacoes
UNION ALL SELECT 'ordem_chave_unica', 'warn', (SELECT count(*) FROM (SELECT 1 FROM fato_ordem_bancaria WHERE id_ob_origem IS NOT NULL AND ano IS NOT NULL GROUP BY id_ob_origem, ano HAVING count(*) > 1))
UNION ALL SELECT 'orgao_chave_unica', 'warn', (SELECT count(*) FROM (SELECT 1 FROM dim_orgao WHERE codigo IS NOT NULL AND ano IS NOT NULL GROUP BY codigo, ano HAVING count(*) > 1))
UNION ALL SELECT 'score_chave_unica', 'warn', (SELECT count(*) FROM (SELECT 1 FROM score_anomalia_contrato WHERE id_contrato_origem IS NOT NULL AND ano IS NOT NULL GROUP BY id_contrato_origem, ano HAVING count(*) > 1))
UNION ALL SELECT 'ingestao_chave_unica', 'warn', (SELECT count(*) FROM (SELECT carga_id FROM bronze_ingestao WHERE carga_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'contrato_sem_orgao', 'warn', (SELECT count(*) FROM fc WHERE sk_orgao IS NULL)
UNION ALL SELECT 'credor_sem_tipo', 'warn', (SELECT count(*) FROM cr WHERE tipo IS NULL)
UNION ALL SELECT 'credor_tipo_aceito', 'warn', (SELECT count(DISTINCT tipo) FROM cr WHERE tipo NOT IN ('PF', 'PJ'))
UNION ALL SELECT 'contrato_credor_existe', 'warn', (SELECT count(*) FROM fc WHERE sk_credor IS NOT NULL AND sk_credor NOT IN (SELECT sk_credor FROM cr WHERE sk_credor IS NOT NULL))
UNION ALL SELECT 'contrato_valor_nao_negativo', 'warn', (SELECT count(*) FROM fc WHERE valor_contrato < 0)
UNION ALL SELECT 'ordem_valor_nao_negativo', 'warn', (SELECT count(*) FROM fo WHERE valor < 0)
UNION ALL SELECT 'score_no_intervalo', 'error', (SELECT count(*) FROM sc WHERE score_anomalia < 0 OR score_anomalia > 1)""", "fc", "fo", "cr", "sc")
def op_dq(spark: SparkSession, d: str) -> DataFrame:
    return quality.run(checks(spark, d))


# OP-VALID as counts, AG-23
@query("SELECT 'id' AS coluna, count(*) FILTER (WHERE id IS NULL OR trim(id) = '') AS vazias FROM empenhos UNION ALL SELECT 'ano', count(*) FILTER (WHERE ano IS NULL) FROM empenhos UNION ALL SELECT 'dataemissao', count(*) FILTER (WHERE dataemissao IS NULL OR trim(dataemissao) = '') FROM empenhos UNION ALL SELECT 'valor', count(*) FILTER (WHERE valor IS NULL) FROM empenhos")
def op_blank_counts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "empenhos")
    cols = ["id", "ano", "dataemissao", "valor"]
    one = e.agg(*[F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(c) for c in cols])
    return one.unpivot([], cols, "coluna", "vazias")


# FN-01, FN-02, FN-06, FN-07
@query("SELECT linha_id, strftime(data, '%d/%m/%Y') AS dia, CAST(year(data) AS INTEGER) AS ano_data, CAST(month(data) AS INTEGER) AS mes FROM fe", "fe")
def fn01_dates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "empenhos").select("linha_id", rules.iso_day_text(F.col("dataemissao")).alias("t"), rules.as_day(F.col("dataemissao")).alias("d"))
    y, m = rules.year_month(F.col("t"))
    return e.select("linha_id", rules.br_day_text(F.col("d")).alias("dia"), F.when(F.col("d").isNotNull(), y).alias("ano_data"), F.when(F.col("d").isNotNull(), m).alias("mes"))


# FN-04, FN-05
@query("SELECT DISTINCT cnpj_cpf AS original, regexp_replace(cnpj_cpf, '[^0-9]', '', 'g') AS numeros, CASE length(regexp_replace(cnpj_cpf, '[^0-9]', '', 'g')) WHEN 11 THEN 'PF' WHEN 14 THEN 'PJ' ELSE 'INVALIDO' END AS tipo FROM snapshot_credor")
def fn04_tax_ids(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "snapshot_credor").select(F.col("cnpj_cpf").alias("original")).distinct().withColumn("numeros", rules.first_digits(F.col("original")))
    return s.withColumn("tipo", rules.taxpayer_kind(F.col("numeros")))


# FN-08, FN-13
@query("SELECT codigo, ano, lower(md5(concat_ws('||', coalesce(codigo, ''), coalesce(CAST(ano AS VARCHAR), '')))) AS sk FROM og", "og")
def fn08_surrogate(spark: SparkSession, d: str) -> DataFrame:
    return gold.bodies(spark, d).select("codigo", "ano", surrogate_key(F.col("codigo"), F.col("ano")).alias("sk"))


# FN-09
@query("SELECT sk_tempo, CAST(data AS VARCHAR) AS data, CAST(ano AS INTEGER) AS ano, CAST(trimestre AS INTEGER) AS trimestre, CAST(mes AS INTEGER) AS mes, CAST(dia_semana AS INTEGER) AS dia_semana FROM te", "te")
def fn09_calendar(spark: SparkSession, d: str) -> DataFrame:
    return gold.days(spark, d).withColumn("data", F.col("data").cast("string"))


# FN-14
@query("SELECT registro_id, CASE WHEN mem_usage_bytes IS NULL THEN 0 ELSE CAST(floor(round(mem_usage_bytes / 1048576.0, 2) * 1048576) AS BIGINT) END AS bytes FROM infra_metricas_containers")
def fn14_sizes(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "infra_metricas_containers")
    text = F.coalesce(F.concat(F.round(F.col("mem_usage_bytes") / 1048576.0, 2).cast("string"), F.lit("MiB")), F.lit(""))
    return m.select("registro_id", rules.size_bytes(text).alias("bytes"))


# FN-17, FN-18
@query("SELECT doc_id, CAST(len(v) AS INTEGER) AS valores, round(coalesce(list_sum(v), 0), 2) AS soma FROM (SELECT doc_id, list_transform(regexp_extract_all(text, 'R\\$\\s?([0-9]{1,3}(?:\\.[0-9]{3})*(?:,[0-9]{1,2})?|[0-9]+(?:,[0-9]{1,2})?)', 1), lambda x: CAST(replace(replace(x, '.', ''), ',', '.') AS DOUBLE)) AS v FROM documents WHERE text IS NOT NULL)")
def fn17_amounts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "documents").filter("text is not null").select("doc_id", rules.amounts(F.col("text")).alias("v"))
    return a.select("doc_id", F.size("v").alias("valores"), F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 2).alias("soma"))


# FN-19
@query("SELECT id_ob_origem, ano, CASE WHEN valor IS NULL THEN 'não informado' ELSE 'R$ ' || translate(format('{:,.2f}', CAST(valor AS DOUBLE)), ',.', '.,') END AS texto FROM fo", "fo")
def fn19_reais(spark: SparkSession, d: str) -> DataFrame:
    return gold.bank_orders(spark, d).select("id_ob_origem", "ano", rules.reais(F.col("valor")).alias("texto"))


# FN-20, FN-24
@query("SELECT id_contrato_origem, ano, CASE WHEN score_anomalia < 0.70 THEN 'Baixo' WHEN score_anomalia <= 0.85 THEN 'Médio' WHEN score_anomalia IS NOT NULL THEN 'Alto' END AS risco, CASE WHEN coalesce(flag_anomalia, false) THEN 'Sim' ELSE 'Não' END AS marcada FROM sc", "sc")
def fn20_risk(spark: SparkSession, d: str) -> DataFrame:
    return gold.scores(spark, d).select("id_contrato_origem", "ano", rules.risk_class(F.col("score_anomalia")).alias("risco"), rules.yes_no(F.col("flag_anomalia")).alias("marcada"))


# PRJ-06: filters that may be left out
@query("SELECT ano, count(*) AS n FROM fc WHERE ano IN (2024, 2025) GROUP BY ano", "fc")
def prj06_optional(spark: SparkSession, d: str) -> DataFrame:
    f = serve.optional_in(serve.optional_in(gold.contracts(spark, d), "ano", [2024, 2025]), "sk_orgao", [])
    return f.groupBy("ano").agg(F.count("*").alias("n"))


# AG-25, SL-05 and tumbling days on the event table (an extension)
@query("SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dia, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS valor FROM events GROUP BY 1, 2")
def ev_daily(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy(F.date_format(F.window("ts", "1 day")["start"], "yyyy-MM-dd").alias("dia"), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(15,2)")).cast("decimal(18,2)").alias("valor"))


# TPC-like star: INNER star join with broadcast of the small dimensions only
@query("SELECT r.r_name, n.n_name, CAST(sum(CAST(o.o_totalprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS total, count(*) AS pedidos FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2")
def jn07_star(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rel.lookup(o, n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name", "n_name").agg(F.sum(F.col("o_totalprice").cast("decimal(15,2)")).cast("decimal(18,2)").alias("total"), F.count("*").alias("pedidos"))


# OP-IFOREST, FN-10, AG-12 (rows only: random trees can't be told in SQL)
@query()
def op_iforest(spark: SparkSession, d: str) -> DataFrame:
    from erario.ml import anomaly

    f = op_features(spark, d).withColumn("chave", F.concat_ws("/", "id_contrato_origem", F.col("ano").cast("string")))
    cols = ["valor", "emergencia", "status_VIGENTE", "status_ENCERRADO", "status_RESCINDIDO"]
    forest = anomaly.train(f, "chave", cols)
    return anomaly.scored(f, cols, forest, 0.05).select("id_contrato_origem", "ano", "score_anomalia", "flag_anomalia")


# OP-QREG, OP-FCST with the first candidate's settings (rows only; op_tune compares all candidates)
@query()
def op_forecast(spark: SparkSession, d: str) -> DataFrame:
    from erario.ml import forecast

    return forecast.forecasts(spark, op_panel(spark, d), forecast.GRID[0])


# OP-GATES as metrics of both models (rows only)
@query()
def op_gates(spark: SparkSession, d: str) -> DataFrame:
    from erario.ml import anomaly, forecast

    p = op_panel(spark, d)
    q = forecast.quality(forecast.forecasts(spark, p, forecast.GRID[0]))
    lag4 = p.agg(F.avg(F.col("lag_4").isNotNull().cast("int")).alias("x")).first()["x"] or 0.0
    scores = anomaly.summary(op_iforest(spark, d))
    before = gold.scores(spark, d, {"score_anomalia"}).agg(F.avg("score_anomalia").alias("m")).first()["m"]  # the run before
    said = [*forecast.alerts(q, lag4), *anomaly.alerts(scores, before)]
    return forecast.run_metrics(spark, "backtest", q | {"lag4": lag4, "alertas": len(said), "score_medio": scores["media"], "score_anterior": before or 0.0, "score_p50": scores["p50"], "score_p99": scores["p99"]})


# FN-10
@query("SELECT sk_credor, date_diff('day', CAST(valido_de AS DATE), CAST(valido_ate AS DATE)) AS dias FROM cr WHERE valido_ate IS NOT NULL", "cr")
def fn10_duration(spark: SparkSession, d: str) -> DataFrame:
    c = gold.creditors(spark, d).filter("valido_ate is not null")
    return c.select("sk_credor", F.datediff(F.col("valido_ate").cast("date"), F.col("valido_de").cast("date")).cast("bigint").alias("dias"))


# WN-09
@query("SELECT codigo_orgao, ano_previsto, trimestre_previsto, is_backtest, round(greatest(valor_previsto_p10, 0), 2) AS p10, round(greatest(valor_previsto_p10, valor_previsto_p50, 0), 2) AS p50, round(greatest(valor_previsto_p10, valor_previsto_p50, valor_previsto_p90, 0), 2) AS p90 FROM pv WHERE valor_previsto_p10 IS NOT NULL AND valor_previsto_p50 IS NOT NULL AND valor_previsto_p90 IS NOT NULL", "pv")
def wn09_monotone(spark: SparkSession, d: str) -> DataFrame:
    p = gold.forecasts(spark, d).dropna(subset=["valor_previsto_p10", "valor_previsto_p50", "valor_previsto_p90"])
    a, b, c = (F.col(f"valor_previsto_p{q}") for q in (10, 50, 90))
    zero = F.lit(0.0)
    return p.select("codigo_orgao", "ano_previsto", "trimestre_previsto", "is_backtest", F.round(F.greatest(a, zero), 2).alias("p10"), F.round(F.greatest(a, b, zero), 2).alias("p50"), F.round(F.greatest(a, b, c, zero), 2).alias("p90"))


# AG-24
@query("SELECT data_snapshot::VARCHAR AS extrato, count(*) AS linhas, count(*) - count(DISTINCT (cnpj_cpf, nome, tipo, historico_infringement)) AS repetidas FROM snapshot_credor GROUP BY 1")
def ag24_duplicates(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "snapshot_credor")
    whole = F.struct("cnpj_cpf", "nome", "tipo", "historico_infringement")
    one = s.groupBy("data_snapshot", whole.alias("r")).agg(F.count("*").alias("n"))
    return one.groupBy(F.col("data_snapshot").cast("string").alias("extrato")).agg(F.sum("n").alias("linhas"), (F.sum("n") - F.count("*")).alias("repetidas"))


# OP-DQHIST: the warnings of a run
@query("SELECT teste, violacoes FROM (SELECT 'contrato_sem_orgao' AS teste, (SELECT count(*) FROM fc WHERE sk_orgao IS NULL) AS violacoes UNION ALL SELECT 'ordem_valor_nao_negativo', (SELECT count(*) FROM fo WHERE valor < 0) UNION ALL SELECT 'credor_sem_tipo', (SELECT count(*) FROM cr WHERE tipo IS NULL)) WHERE violacoes > 0", "fc", "fo", "cr")
def op_dqhist(spark: SparkSession, d: str) -> DataFrame:
    keep = ("contrato_sem_orgao", "ordem_valor_nao_negativo", "credor_sem_tipo")
    h = quality.warning_history([c for c in checks(spark, d) if c.name in keep], F.current_timestamp())
    return h.select("teste", "violacoes")


# Skew-safe running totals of each body (the ranges operator as a query)
@query("SELECT sk_orgao, id_ob_origem, ano, row_number() OVER w AS row_in_key, coalesce(CAST(sum(valor) OVER (PARTITION BY sk_orgao ORDER BY ano, id_ob_origem ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)), 0) AS acumulado FROM fo WINDOW w AS (PARTITION BY sk_orgao ORDER BY ano, id_ob_origem)", "fo")
def p3_running(spark: SparkSession, d: str) -> DataFrame:
    from erario.operators.ranges import running

    f = gold.bank_orders(spark, d).select("sk_orgao", "ano", "id_ob_origem", (F.col("valor") * 100).cast("bigint").alias("centavos"))
    r = running(f, "sk_orgao", ["ano", "id_ob_origem"], "centavos")
    return r.select("sk_orgao", "id_ob_origem", "ano", "row_in_key", (F.col("total_in_key") / 100).cast("decimal(18,2)").alias("acumulado"))
