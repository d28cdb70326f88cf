"""Raw batches to conformed tables: declarative specifications and one pipeline for all sources."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.functions import rules
from erario.operators import quality
from erario.operators.lake import Lake
from erario.operators.relational import dedup
from erario.sources.batches import read_batch

#: Column that tells which run a row came with.
MARKER = "_data_extracao"


@dataclass(frozen=True)
class Source:
    """How one source is conformed: its key, dates as text, money, partitions and what must be filled."""

    name: str
    keys: tuple[str, ...]
    day: str | None = None
    dates: tuple[str, ...] = ()
    money: tuple[str, ...] = ()
    tax_id: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    minimum: int = 0
    partitions: tuple[str, ...] = field(default=("ano", "mes"))


SOURCES: dict[str, Source] = {
    s.name: s
    for s in (
        Source("contratos", ("id",), "data_assinatura", ("data_assinatura", "data_inicio", "data_termino"), ("valor_contrato", "calculated_valor_pago", "calculated_valor_empenhado", "calculated_valor_aditivo", "calculated_valor_ajuste"), ("plain_cpf_cnpj_financiador", "cpf_cnpj_financiador"), ("id", "valor_contrato", "data_assinatura", "cod_gestora")),
        Source("empenhos", ("id", "ano"), "dataemissao", ("dataemissao",), (), (), ("id", "ano", "dataemissao")),
        Source("ordem_bancaria_orcamentaria", ("id", "ano"), "dataemissao", ("dataemissao",), (), (), ("id", "ano", "dataemissao")),
        Source("unidade_gestora", ("codigo", "ano"), None, (), (), (), ("codigo", "ano"), 4000, ("ano",)),
    )
}


def normalize(df: DataFrame, source: str) -> DataFrame:
    """Dates as ISO text, tax id as digits with the kind of creditor; columns that are absent are left absent."""
    s = SOURCES[source]
    for c in s.dates:
        if c in df.columns:
            df = df.withColumn(c, rules.iso_day_text(F.col(c).cast("string")) if source == "contratos" else F.substring(F.col(c).cast("string"), 1, 10))
    ids = [F.col(c).cast("string") for c in s.tax_id if c in df.columns]
    if ids:
        df = df.withColumn("cnpj_cpf", rules.first_digits(*ids)).withColumn("tipo_credor", rules.taxpayer_kind(F.col("cnpj_cpf")))
    return df


def add_partitions(df: DataFrame, source: str) -> DataFrame:
    """ano and mes from the event date; an ``ano`` of the source stays; null where there is no date."""
    s = SOURCES[source]
    if s.day is None or s.day not in df.columns:
        year = F.col("ano").try_cast("int") if "ano" in df.columns else F.lit(None).cast("int")
        month = F.lit(None).cast("int")
    else:
        y, month = rules.year_month(F.col(s.day))
        year = F.col("ano").try_cast("int") if "ano" in df.columns else y
    df = df.withColumn("ano", year)
    return df.withColumn("mes", month) if "mes" in s.partitions else df


def type_columns(df: DataFrame, source: str) -> DataFrame:
    """Typed dates and money; text that is neither becomes null."""
    s = SOURCES[source]
    for c in s.dates:
        if c in df.columns:
            df = df.withColumn(c, rules.as_day(F.col(c)))
    for c in s.money:
        if c in df.columns:
            df = df.withColumn(c, rules.money(F.col(c)))
    return df


def dedup_batch(df: DataFrame, source: str) -> DataFrame:
    """One row a key, the same one in every run."""
    return dedup(df, [k for k in SOURCES[source].keys if k in df.columns])


def conform(df: DataFrame, source: str, run_date: str) -> DataFrame:
    """A raw batch as rows of the conformed table."""
    out = dedup_batch(type_columns(add_partitions(normalize(df, source), source), source), source)
    return out.withColumn(MARKER, F.lit(run_date).cast("date"))


def write_source(lake: Lake, source: str, df: DataFrame) -> int:
    """Merge a conformed batch into ``silver.<source>``; returns the rows of the table."""
    s = SOURCES[source]
    return lake.merge(f"silver.{source}", df, [k for k in s.keys if k in df.columns], MARKER)


def run(spark: SparkSession, lake: Lake, root: str, run_date: str) -> dict[str, int]:
    """Conform and merge all sources of one run date: {source: rows of its table}; sources without a batch are left out."""
    out = {}
    for name in SOURCES:
        df = read_batch(spark, root, name, run_date)
        if df is not None:
            out[name] = write_source(lake, name, conform(df, name, run_date))
    return out


def validate(spark: SparkSession, root: str, run_date: str, minimum: dict[str, int] | None = None) -> dict[str, dict[str, int]]:
    """{source: {"registros": n}} of all sources; raises at the first one that is bad (see quality.validate_batch)."""
    out = {}
    for name, s in SOURCES.items():
        out[name] = quality.validate_batch(read_batch(spark, root, name, run_date), s.required, (minimum or {}).get(name, s.minimum), name)
    return out


def record_counts(lake: Lake, run_date: str, counts: dict[str, int]) -> int:
    """Keep one row for each (fonte, data_extracao) in ``audit.bronze_ingestao``; a later call replaces it."""
    rows = lake.spark.createDataFrame([(k, run_date, int(v)) for k, v in counts.items()], "fonte string, data_extracao string, registros bigint").withColumn("gravado_em", F.current_timestamp())
    return lake.merge("audit.bronze_ingestao", rows, ["fonte", "data_extracao"], "gravado_em")
