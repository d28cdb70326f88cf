"""Range reads of source tables over JDBC, or over Parquet where tests stand in for the database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables that may be read, and the column their ranges go by (None: read whole).
TABLES: dict[str, str | None] = {"empenhos": "dataemissao", "ordem_bancaria_orcamentaria": "dataemissao", "unidade_gestora": None}
#: Rows that the cursor fetches at once.
FETCH = 20_000


def read_range(spark: SparkSession, table: str, start: str, end: str, url: str | None = None, parquet: str | None = None, partitions: int = 1, key: str = "id", **options: str) -> DataFrame:
    """Rows of ``table`` with start <= date <= end, compared as text as the source does.

    Dates are stored as text with a time, so rows of the day ``end`` itself sort after it and are left to the next run,
    whose lookback takes them. The filter is pushed to the source. ValueError for a table that isn't listed.
    """
    if table not in TABLES:
        raise ValueError(f"unknown table {table}")
    if parquet:
        df = spark.read.parquet(parquet)
    else:
        r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", FETCH).options(**options)
        if partitions > 1:
            low, high = _bounds(spark, url, table, key, options)
            r = r.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", partitions)
        df = r.load()
    day = TABLES[table]
    return df.filter((F.col(day) >= start) & (F.col(day) <= end)) if day else df


def _bounds(spark: SparkSession, url: str | None, table: str, key: str, options: dict[str, str]) -> tuple[int, int]:
    r = spark.read.format("jdbc").option("url", url).option("query", f"select min({key}) as a, max({key}) as b from {table}").options(**options).load().first()
    return int(r["a"] or 0), int(r["b"] or 0)
