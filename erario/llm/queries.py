"""Queries of the corpus problems (1, 5, 7, 8, 9), and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.llm import increments, leaks, names, subjects, tokens
from erario.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(linha_id): rows of empenhos that are the same commitment as an earlier row."""
    return increments.repeated(table(spark, sf_dir, "empenhos"), table(spark, sf_dir, "bronze_ingestao"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cnpj_cpf_a, cnpj_cpf_b): pairs of creditors that are one entity."""
    return names.pairs(table(spark, sf_dir, "dim_credor"))


def p5_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cnpj_cpf, entidade, formas): the entity of each creditor."""
    return names.entities(table(spark, sf_dir, "dim_credor"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids): token ids of every document."""
    return tokens.encode(table(spark, sf_dir, "documents"), ["doc_id"])


def p7_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grupo, documentos, tokens, distintos) by language."""
    return tokens.counts(table(spark, sf_dir, "documents"), "lang")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id): documents that hold an evaluation item or a good part of it."""
    return leaks.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, documentos): in how many documents each leaked item stands."""
    return p8_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documentos"))


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.subjects(*(table(spark, sf_dir, t) for t in ("documents", "rotulos_assunto", "assuntos")))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, assunto): the areas that each document deals with."""
    return _subjects(spark, sf_dir)


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(assunto, documentos): documents of the corpus by area."""
    return _subjects(spark, sf_dir).groupBy("assunto").agg(F.count("*").alias("documentos"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found, "p5_found": p5_found, "p5_entities": p5_entities, "p7_ids": p7_ids, "p7_counts": p7_counts, "p8_found": p8_found, "p8_items": p8_items,
    "p9_found": p9_found, "p9_composition": p9_composition,
}
SQL: dict[str, str] = {}
