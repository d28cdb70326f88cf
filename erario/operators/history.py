"""History of changing attributes: a change log for each attribute, combined into versions.

Every attribute has its own log of (entity, date, value) with one entry for each change and so its own intervals. The
versions of an entity are cut at the union of the boundary dates of all attributes; between two cuts each attribute has
one value. Neighbouring pieces that agree in all attributes are coalesced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from erario.functions.keys import digits, stripped, surrogate_key


def last_loaded(df: DataFrame, keys: Sequence[str], loaded: str, rest: Sequence[str]) -> DataFrame:
    """One row for each key: the one loaded last, ties broken by the values themselves (largest, nulls smallest).

    A map-side aggregation, so repeated rows of a hot key are reduced before the shuffle.
    """
    return df.groupBy(*keys).agg(F.max(F.struct(loaded, *rest)).alias("__last")).select(*keys, *[F.col("__last")[c].alias(c) for c in (loaded, *rest)])


def change_log(seen: DataFrame, entity: str, at: str, attributes: dict[str, Column]) -> DataFrame:
    """(entity, at, atributo, valor, desde_sempre): an entry for the first value of each attribute and for each change.

    seen: one row for each entity and date; attributes: name -> the value compared, as text; null is a value.
    """
    entries = seen.select(entity, at, F.explode(F.array(*[F.struct(F.lit(n).alias("atributo"), c.cast("string").alias("valor")) for n, c in attributes.items()])).alias("e")).select(entity, at, "e.atributo", "e.valor")
    w = Window.partitionBy(entity, "atributo").orderBy(F.col(at).asc_nulls_first())
    before = F.lag(F.struct("valor")).over(w)
    return entries.withColumn("__b", before).filter(F.col("__b").isNull() | ~F.col("__b")["valor"].eqNullSafe(F.col("valor"))).drop("__b")


def attribute_intervals(log: DataFrame, entity: str, at: str) -> DataFrame:
    """(entity, atributo, valor, de, ate): the interval of each entry of a change log, open at the end (ate null)."""
    w = Window.partitionBy(entity, "atributo").orderBy(F.col(at).asc_nulls_first())
    return log.select(entity, "atributo", "valor", F.col(at).alias("de"), F.lead(at).over(w).alias("ate"))


def combine(intervals: DataFrame, entity: str, names: Sequence[str]) -> DataFrame:
    """(entity, de, ate, *names): versions cut at the union of all boundary dates, equal neighbours coalesced.

    At each boundary the attributes that change there bring their value, the others carry on the last one; a struct
    around the value keeps a change to null apart from no change.
    """
    cuts = intervals.groupBy(entity, "de").agg(*[F.max(F.when(F.col("atributo") == n, F.struct("valor"))).alias(n) for n in names])
    w = Window.partitionBy(entity).orderBy(F.col("de").asc_nulls_first())
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    pieces = cuts.select(entity, "de", *[F.last(n, ignorenulls=True).over(upto)["valor"].alias(n) for n in names])
    before = F.lag(F.struct(*names)).over(w)
    new = pieces.withColumn("__b", before).filter(F.col("__b").isNull() | ~F.col("__b").eqNullSafe(F.struct(*names))).drop("__b")
    return new.withColumn("ate", F.lead("de").over(w)).select(entity, "de", "ate", *names)


def creditor_versions(dim: DataFrame, snapshots: DataFrame) -> DataFrame:
    """All versions of each creditor from the dimension's history and the periodic snapshots that follow it.

    Columns: sk_credor, cnpj_cpf, nome, tipo, historico_infringement, valido_de, valido_ate, versao_atual, aberta_por.
    Closed versions of ``dim`` are passed on with their keys; its current version (versao_atual) is the base that the
    first snapshot is compared with, and stays as it is unless a snapshot changes it. A creditor unknown to ``dim`` gets
    a first version from its first snapshot. Within a creditor and date the row loaded last counts. Letter case and outer
    blanks of nome don't count; null is a value; a creditor missing from a snapshot stays open. Rows without any digit
    in cnpj_cpf have no entity and are left out. New versions carry nome in upper case without outer blanks and get
    sk_credor as md5 of cnpj_cpf and valido_de. Empty
    inputs give what the other one has.
    """
    d = dim.select("sk_credor", digits(F.col("cnpj_cpf")).alias("cnpj_cpf"), "nome", "tipo", "historico_infringement", "valido_de", "valido_ate", "versao_atual", "carregado_em").filter("cnpj_cpf is not null")
    closed = d.filter("not coalesce(versao_atual, false)").drop("carregado_em").distinct()
    base = last_loaded(d.filter("versao_atual"), ["cnpj_cpf"], "valido_de", ["carregado_em", "sk_credor", "nome", "tipo", "historico_infringement"])
    s = snapshots.select(digits(F.col("cnpj_cpf")).alias("cnpj_cpf"), F.col("data_snapshot").cast("date").alias("em"), "nome", "tipo", "historico_infringement", "carregado_em").filter("cnpj_cpf is not null and em is not null")
    s = last_loaded(s, ["cnpj_cpf", "em"], "carregado_em", ["nome", "tipo", "historico_infringement"])
    # the base stands before all snapshots: date null
    seen = base.select("cnpj_cpf", F.lit(None).cast("date").alias("em"), "nome", "tipo", "historico_infringement").unionByName(s.drop("carregado_em"))
    names = {"nome": F.upper(stripped(F.col("nome"))), "tipo": F.col("tipo"), "historico_infringement": F.col("historico_infringement")}
    log = change_log(seen, "cnpj_cpf", "em", names)
    v = combine(attribute_intervals(log, "cnpj_cpf", "em"), "cnpj_cpf", list(names))
    opened = v.filter("de is not null").select(
        surrogate_key(F.col("cnpj_cpf"), F.date_format("de", "yyyy-MM-dd")).alias("sk_credor"), "cnpj_cpf", "nome", "tipo",
        F.col("historico_infringement").try_cast("boolean").alias("historico_infringement"), F.col("de").cast("timestamp_ntz").alias("valido_de"), F.col("ate").cast("timestamp_ntz").alias("valido_ate"), F.lit("snapshot").alias("aberta_por"),
    )
    ends = v.filter("de is null").select("cnpj_cpf", F.col("ate").cast("timestamp_ntz").alias("valido_ate"))
    current = base.drop("carregado_em").join(ends, "cnpj_cpf", "left").withColumn("aberta_por", F.lit("dim_credor"))
    out = ["sk_credor", "cnpj_cpf", "nome", "tipo", "historico_infringement", "valido_de", "valido_ate", "aberta_por"]
    old = closed.withColumn("aberta_por", F.lit("dim_credor")).select(*out)
    cast = lambda x: x.withColumn("valido_de", F.col("valido_de").cast("timestamp_ntz")).withColumn("valido_ate", F.col("valido_ate").cast("timestamp_ntz"))
    old, current = cast(old).withColumn("versao_atual", F.lit(False)), cast(current.select(*out)).withColumn("versao_atual", F.col("valido_ate").isNull())
    return old.unionByName(current).unionByName(opened.withColumn("versao_atual", F.col("valido_ate").isNull())).select("sk_credor", "cnpj_cpf", "nome", "tipo", "historico_infringement", "valido_de", "valido_ate", "versao_atual", "aberta_por")
