"""Versioned Parquet tables: create, append, merge, replace, evolve, expire, retain, compact.

A table is a directory of immutable leaves (directories of Parquet files, one for each write and partition value), a list
of leaves for each version (``v-….json``), and ``_current.json``, which names the version that readers take. Writers add
leaves and move the pointer in one step of the file system; readers that hold an older version aren't disturbed. An
append only adds its own rows; a merge rewrites only the partitions that its batch has rows of, where the partition
columns are part of the key. One writer per table at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erario.operators import relational
from erario.operators.compaction import read_text, replace_text

#: Seconds for which leaves that no version names are left alone: they may be those of a writer at work.
GRACE = 86_400.0


class Lake:
    """Tables below one warehouse directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _list(self, path: str) -> list:
        fs, p = self._fs(path)
        return list(fs.listStatus(p)) if fs.exists(p) else []

    def log(self, name: str) -> list[dict]:
        """Snapshots of a table, oldest first: version, at (seconds), rows, operation, schema, partition_by."""
        text = read_text(self.spark, f"{self._path(name)}/_current.json")
        return json.loads(text)["log"] if text else []

    def snapshots(self, name: str) -> DataFrame:
        """The snapshot log as a DataFrame (version, at, rows, operation)."""
        return self.spark.createDataFrame([(x["version"], float(x["at"]), int(x["rows"]), x["operation"]) for x in self.log(name)], "version string, at double, rows bigint, operation string")

    def exists(self, name: str) -> bool:
        return bool(self.log(name))

    def tables(self) -> list[str]:
        """Names of all tables at any depth, sorted."""
        found, todo = [], [""]
        while todo:
            at = todo.pop()
            entries = self._list(f"{self.root}{at}")
            if any(x.getPath().getName() == "_current.json" for x in entries):
                found.append(at[1:].replace("/", "."))
            else:
                todo += [f"{at}/{x.getPath().getName()}" for x in entries if x.isDirectory()]
        return sorted(found)

    def _entry(self, name: str, version: str | None = None) -> dict:
        log = self.log(name)
        if not log:
            raise FileNotFoundError(name)
        return next(x for x in reversed(log) if version in (None, x["version"]))

    def leaves(self, name: str, version: str | None = None) -> list[dict]:
        """path, partition and rows of each leaf of a version."""
        return json.loads(read_text(self.spark, f"{self._path(name)}/{self._entry(name, version)['version']}.json"))

    def _rows(self, name: str, schema: T.StructType, leaves: list[dict]) -> DataFrame:
        if not leaves:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self._path(name)}/{x['path']}" for x in leaves])

    def read(self, name: str, schema: T.StructType | None = None, version: str | None = None) -> DataFrame:
        """The current (or a named) version; with a schema, an empty table where there is none yet."""
        if schema is not None and not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return self._rows(name, T.StructType.fromJson(self._entry(name, version)["schema"]), self.leaves(name, version))

    def ensure(self, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> bool:
        """Create an empty table if there is none; whether it was created."""
        if self.exists(name):
            return False
        self.replace(name, self.spark.createDataFrame([], schema), partition_by, "create")
        return True

    def add_columns(self, name: str, fields: Sequence[T.StructField]) -> list[str]:
        """Add the columns that the table doesn't have, as nulls; no row is rewritten. Returns their names."""
        last = self._entry(name)
        schema = T.StructType.fromJson(last["schema"])
        new = [f for f in fields if f.name not in schema.names]
        if new:
            self._commit(name, self.leaves(name), T.StructType([*schema.fields, *new]), last["partition_by"], "evolve")
        return [f.name for f in new]

    def _write(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> list[dict]:
        """Write rows as new leaves, one for each partition value; rows are counted as they are written."""
        part = f"p-{uuid.uuid4().hex}"
        base = f"{self._path(name)}/{part}"
        if not partition_by:
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(base)
            return [{"path": part, "partition": "", "rows": int(seen.get["n"])}]
        # the columns stay in the files, so that a leaf can be read by itself
        keys = [f"__p_{c}" for c in partition_by]
        df.withColumns({k: F.col(c) for k, c in zip(keys, partition_by)}).write.partitionBy(*keys).parquet(base)
        found, todo = [], [""]
        while todo:
            at = todo.pop()
            dirs = [x.getPath().getName() for x in self._list(f"{base}{at}") if x.isDirectory()]
            if dirs:
                todo += [f"{at}/{x}" for x in dirs]
            elif at:
                found.append(at[1:])
        return [{"path": f"{part}/{x}", "partition": x, "rows": self.spark.read.schema(df.schema).parquet(f"{base}/{x}").count()} for x in sorted(found)]

    def _commit(self, name: str, leaves: list[dict], schema: T.StructType, partition_by: Sequence[str], operation: str) -> int:
        version = f"v-{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        rows = sum(x["rows"] for x in leaves)
        replace_text(self.spark, f"{self._path(name)}/{version}.json", json.dumps(leaves))
        entry = {"version": version, "at": time.time(), "rows": rows, "operation": operation, "schema": json.loads(schema.json()), "partition_by": list(partition_by)}
        replace_text(self.spark, f"{self._path(name)}/_current.json", json.dumps({"log": [*self.log(name), entry]}))
        return rows

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), operation: str = "replace") -> int:
        """Write ``df`` as the new version of the table and point readers to it; returns its rows.

        Until the pointer moves, readers see the version before.
        """
        return self._commit(name, self._write(name, df, partition_by), df.schema, partition_by, operation)

    def append(self, name: str, df: DataFrame) -> int:
        """Add rows and return their number; creates the table. Only these rows are written. No rows, no new version."""
        if df.isEmpty():
            return 0
        if not self.exists(name):
            return self.replace(name, df, operation="append")
        last = self._entry(name)
        schema = relational.evolve(self.spark.createDataFrame([], T.StructType.fromJson(last["schema"])), df).schema
        new = self._write(name, relational.align(df, self.spark.createDataFrame([], schema)), last["partition_by"])
        self._commit(name, [*self.leaves(name), *new], schema, last["partition_by"], "append")
        return sum(x["rows"] for x in new)

    def append_stamped(self, name: str, df: DataFrame, stamp: str = "coletado_em") -> int:
        """Append collected rows with the time of collection."""
        return self.append(name, df.withColumn(stamp, F.current_timestamp()))

    def replace_distinct(self, name: str, df: DataFrame) -> int:
        """The table becomes the distinct rows of ``df``."""
        return self.replace(name, df.distinct())

    def merge(self, name: str, batch: DataFrame, keys: Sequence[str], marker: str, partition_by: Sequence[str] = ()) -> int:
        """Upsert a batch: one row a key, order-safe and repeatable (see ``relational.merge``); returns the table's rows.

        Partition columns that are all keys confine the rewrite to the partitions the batch has rows of.
        """
        one = relational.dedup(batch, keys, [marker])
        if not self.exists(name):
            return self.replace(name, one, partition_by, "create")
        last, leaves = self._entry(name), self.leaves(name)
        schema, parts = T.StructType.fromJson(last["schema"]), last["partition_by"]
        touched, rest = leaves, []
        if parts and set(parts) <= set(keys):
            aligned = relational.align(batch, self.spark.createDataFrame([], relational.evolve(self.spark.createDataFrame([], schema), batch).schema))
            values = [tuple(r) for r in aligned.select(*parts).distinct().collect()]  # the partitions of one batch
            names = {"/".join(f"__p_{c}={_directory(v)}" for c, v in zip(parts, vs)) for vs in values}
            touched, rest = [x for x in leaves if x["partition"] in names], [x for x in leaves if x["partition"] not in names]
        new = relational.merge(self._rows(name, schema, touched), one, keys, marker)
        return self._commit(name, [*rest, *self._write(name, new, parts)], new.schema, parts, "merge")

    def retain(self, name: str, stamp: str, days: int, now: Column) -> int:
        """Drop rows whose ``stamp`` is more than ``days`` before ``now``; rows without a stamp stay. Returns the rows left.

        Only leaves that have such rows are rewritten.
        """
        last, leaves = self._entry(name), self.leaves(name)
        schema = T.StructType.fromJson(last["schema"])
        limit = now - F.make_dt_interval(F.lit(days))
        old = self._rows(name, schema, leaves).filter(F.col(stamp) < limit).select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("d")).distinct().collect()  # at most the leaves
        names = {r["d"] for r in old}
        hit = [x for x in leaves if any(d.endswith("/" + x["path"]) for d in names)]
        if not hit:
            return last["rows"]
        kept = self._rows(name, schema, hit).filter(F.col(stamp).isNull() | (F.col(stamp) >= limit))
        return self._commit(name, [*[x for x in leaves if x not in hit], *self._write(name, kept, last["partition_by"])], schema, last["partition_by"], "retain")

    def expire(self, name: str, keep_seconds: float, grace: float = GRACE) -> list[str]:
        """Forget versions older than ``keep_seconds`` but the current one; delete what no version names any more.

        Of that, leaves younger than ``grace`` seconds stay unless a version forgotten here named them: they may be those
        of a writer that hasn't committed. Returns the versions forgotten.
        """
        log = self.log(name)
        limit = time.time() - keep_seconds
        kept = [x for i, x in enumerate(log) if i == len(log) - 1 or x["at"] >= limit]
        gone = [x["version"] for x in log if x not in kept]
        dropped = {y["path"].split("/")[0] for v in gone for y in self.leaves(name, v)}
        needed = {y["path"].split("/")[0] for x in kept for y in self.leaves(name, x["version"])}
        replace_text(self.spark, f"{self._path(name)}/_current.json", json.dumps({"log": kept}))
        fs, _ = self._fs(self._path(name))
        for x in self._list(self._path(name)):
            n, old = x.getPath().getName(), time.time() - x.getModificationTime() / 1000 > grace
            if n.startswith("p-") and n not in needed and (n in dropped or old) or n.removesuffix(".json") in gone or n.endswith(".tmp") and old:
                fs.delete(x.getPath(), True)
        return gone

    def compact(self, name: str, files: int, slice_by: str | None = None) -> int:
        """Rewrite the current version into ``files`` files a partition; returns the table's rows.

        slice_by: a partition column, whose values are rewritten one after the other: no job holds more than one of them.
        """
        last, leaves = self._entry(name), self.leaves(name)
        schema, parts = T.StructType.fromJson(last["schema"]), last["partition_by"]
        if slice_by is not None and slice_by not in parts:
            parts = [slice_by]  # not partitioned by it so far: all at once
            return self._commit(name, self._write(name, self._rows(name, schema, leaves).repartition(files, slice_by), parts), schema, parts, "compact")
        groups: dict[str, list[dict]] = {}
        for x in leaves:
            groups.setdefault(x["partition"] if slice_by else "", []).append(x)
        new = [y for g in groups.values() for y in self._write(name, self._rows(name, schema, g).coalesce(files), parts)]
        return self._commit(name, new, schema, parts, "compact")


def _directory(value: object) -> str:
    """A partition value as Spark writes it into a directory's name."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return "".join(c if c.isalnum() or c in "-_. ,;()~!@&$+|" else f"%{ord(c):02X}" for c in text)
