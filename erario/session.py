"""Session factory and the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SHARED_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "erario", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect: UTC and adaptive execution with skew handling.

    ANSI mode stays on; all lenient conversions in this package use ``try_*``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only where that is unset, which is the case in local tests, a folder on this machine is used.
    """
    d = spark.conf.get(SHARED_SETTING, None) or spark.sparkContext.getConf().get(SHARED_SETTING)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SHARED_SETTING} to a folder that every executor can reach")
        d = "file://" + os.path.join(tempfile.gettempdir(), "erario-shared")
    return d.rstrip("/")


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage and survives lost executors; unlike ``checkpoint()`` it computes ``df`` once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/erario/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    drop_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers of a session, once; they may run where the repository isn't."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    # the driver's own copy; Spark's file server brings it to the executors
    target = Path(tempfile.mkdtemp(prefix="erario-")) / "erario-package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, Path("erario") / f.relative_to(here))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def drop_on_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediates when the driver ends in order; until then every executor can read it.

    The folder is made where it isn't there yet, as the file system only remembers paths that exist.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def shuffle_width(spark: SparkSession, least: int = 1) -> int:
    """Number of shuffle partitions of the session, at least ``least``."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
