"""Raw JSON batches: discovery of their directories, reading, writing, and the summary of an extract."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erario.operators.compaction import replace_text

#: Records of a file at most, and the file that an extract without rows leaves.
FILE_RECORDS, EMPTY = 20_000, "sem_registros.json"


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(str(x.getPath().toString()) for x in (fs.globStatus(p) or []))


def batch_dirs(spark: SparkSession, root: str, source: str, run_date: str) -> list[str]:
    """Directories of one extraction date at any depth below the source, sorted; none where the root is missing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{source}")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found, todo = [], [p] if fs.exists(p) else []
    while todo:
        for x in fs.listStatus(todo.pop()):
            if x.isDirectory():
                name = x.getPath().getName()
                if name == f"data_extracao={run_date}":
                    found.append(str(x.getPath().toString()))
                elif not name.startswith("data_extracao="):
                    todo.append(x.getPath())
    return sorted(found)


def batch_files(spark: SparkSession, directory: str) -> list[str]:
    """JSON files right below a directory, sorted."""
    return _glob(spark, f"{directory.rstrip('/')}/*.json")


def read_batch(spark: SparkSession, root: str, source: str, run_date: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Rows of one extraction date, JSON arrays or lines; None where there is no directory or no row.

    Without a schema types are inferred from this batch alone; a directory that holds only empty arrays has no row.
    Files that ``write_batch`` made hold a record a line, others one array or record each; both may be mixed.
    """
    files = [f for x in batch_dirs(spark, root, source, run_date) for f in batch_files(spark, x)]
    out: DataFrame | None = None
    for lines in (True, False):
        some = [f for f in files if f.rsplit("/", 1)[-1].startswith("part-") == lines]
        if some:
            reader = spark.read.option("multiLine", not lines)
            df = (reader.schema(schema) if schema else reader).json(some)
            if df.columns:
                out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return None if out is None or out.isEmpty() else out


def sample_batches(spark: SparkSession, files: Sequence[str], limit: int = 8) -> DataFrame:
    """The first files of a source with all columns that any of them has, for a look."""
    out: DataFrame | None = None
    for f in list(files)[:limit]:
        df = spark.read.option("multiLine", True).json(f)
        if df.columns:
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError("no file with rows")
    return out


def write_batch(df: DataFrame, root: str, source: str, run_date: str, day: Column | None) -> None:
    """Write an extract as JSON lines below ano/mes of its event date, or flat where a row has none.

    An extract without rows leaves a file with an empty array, so that "found none" is told from "did not run".
    """
    spark = df.sparkSession
    base = f"{root.rstrip('/')}/{source}"
    leaf = f"data_extracao={run_date}"
    if df.isEmpty():
        write_array(spark, [], f"{base}/{leaf}/{EMPTY}")
        return
    known = F.lit(None).cast("date") if day is None else F.try_to_date(F.substring(day, 1, 10), "yyyy-MM-dd")
    rows = df.withColumn("__day", known)
    dated = rows.filter("__day is not null").withColumn("ano", F.year("__day")).withColumn("mes", F.lpad(F.month("__day").cast("string"), 2, "0")).withColumn("data_extracao", F.lit(run_date)).drop("__day")
    # written row by row below its date; a replay of the same run date replaces its own directories only
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_RECORDS).partitionBy("ano", "mes", "data_extracao").json(base)
    bare = rows.filter("__day is null").drop("__day")
    if not bare.isEmpty():
        bare.write.mode("overwrite").option("maxRecordsPerFile", FILE_RECORDS).json(f"{base}/{leaf}")


def write_array(spark: SparkSession, records: Sequence[dict], path: str) -> None:
    """Write records that the driver holds (a page, a marker) as one JSON array, over what is there; other types as text."""
    replace_text(spark, path, json.dumps(list(records), ensure_ascii=False, default=str))


def extract_summary(df: DataFrame, day: str, pages: int | None = None) -> dict:
    """{"registros": n, "data_maxima": text or None, "paginas": pages}; dates compare by their first ten letters.

    paginas only where ``pages`` is given.
    """
    r = df.agg(F.count("*").alias("n"), F.max(F.substring(F.col(day), 1, 10)).alias("m")).first()
    return {"registros": r["n"], "data_maxima": r["m"]} | ({} if pages is None else {"paginas": pages})
