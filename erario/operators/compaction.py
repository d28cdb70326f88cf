"""Consolidation of countless small files into few well-sized ones per day.

The steps are those of a table rewrite: a frozen manifest of the files, first-fit decreasing of the files of each day
into bins of the target size, one rewritten file for each bin, a check of each bin's row count and checksum against those
of its files in the manifest, and an atomic commit, which readers (``committed``) go by. Nothing that grows with the
number of files is gathered in one place: files of a day are packed by rounded size, so the packing of a day sees some
hundred sizes however many files the day has.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from erario.operators.ranges import matching_groups
from erario.session import shared_dir

#: Sizes are rounded up to numbers of so many binary digits: by 3 % at most.
SIZE_BITS = 6
#: Size of a rewritten file, before encoding and compression.
TARGET_BYTES = 128 << 20


def first_fit_decreasing(counts: Sequence[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Bins for items that come as (size, count), each size once: (size, first item, items, first bin, items a bin).

    Equal bins are held as one group, so the work depends on the number of sizes, not of items. Placing the items of a
    size one by one by first fit fills each bin with as many as it takes before it goes on to the next, which is what
    is done here a group at a time. An item larger than the capacity gets a bin of its own.
    """
    bins: list[list[int]] = []  # [room left, bins in the group], in order of opening
    placed: list[tuple[int, int, int, int, int]] = []
    for size, count in sorted(counts, reverse=True):
        item, left, at, first_bin = 0, count, 0, 0
        while left and at < len(bins):
            room, many = bins[at]
            fit = room // size if size else left
            if fit:
                full = min(many, left // fit)
                if full:
                    placed.append((size, item, full * fit, first_bin, fit))
                    item, left = item + full * fit, left - full * fit
                    bins[at : at + 1] = [[room - fit * size, full], *([[room, many - full]] if many > full else [])]
                    at, first_bin = at + 1, first_bin + full
                    if full < many and left:  # the next bin takes the rest
                        placed.append((size, item, left, first_bin, left))
                        bins[at : at + 1] = [[room - left * size, 1], *([[room, many - full - 1]] if many - full > 1 else [])]
                        left = 0
                    continue
                placed.append((size, item, left, first_bin, left))
                bins[at : at + 1] = [[room - left * size, 1], *([[room, many - 1]] if many > 1 else [])]
                left = 0
                break
            first_bin += many
            at += 1
        if left:
            fit = max(1, capacity // size if size else left)
            full, rest = divmod(left, fit)
            if full:
                placed.append((size, item, full * fit, first_bin, fit))
                bins.append([max(0, capacity - fit * size), full])
                item, first_bin = item + full * fit, first_bin + full
            if rest:
                placed.append((size, item, rest, first_bin, rest))
                bins.append([max(0, capacity - rest * size), 1])
    return placed


def _compared(df: DataFrame, same: Sequence[str]) -> dict[str, Column]:
    """The columns by which rows are equal, as they are compared: -0.0 counts as 0.0."""
    t = {c: df.schema[c].dataType.typeName() for c in same}
    return {c: F.col(c) + F.lit(0).cast(t[c]) if t[c] in ("double", "float") else F.col(c) for c in same}


def repeats(df: DataFrame, record: str, same: Sequence[str]) -> DataFrame:
    """Rows that repeat a row of smaller ``record``, with all columns of ``df``; equal in ``same``, nulls equal.

    Counts of the groups come from a map-side aggregation over the columns themselves; only groups of two or more rows
    are joined back, by a hash and then by each column, the heavy ones by broadcast. A row whose record number is null is
    never a repeat, nor the one that others repeat. Two rows with the same record number are one record: neither repeats
    the other.
    """
    cols = _compared(df, same)
    marked = df.filter(F.col(record).isNotNull()).withColumn("__h", F.xxhash64(*[x for c in cols.values() for x in (c, F.isnull(c))]))
    groups = marked.groupBy("__h", *[c.alias(f"__s{i}") for i, c in enumerate(cols.values())]).agg(F.min(record).alias("__keep"), F.count("*").alias("__n")).filter("__n > 1")
    equal = F.col(record) > F.col("__keep")
    for i, c in enumerate(cols.values()):
        equal = equal & c.eqNullSafe(F.col(f"__s{i}"))
    return matching_groups(marked, groups, ["__h"], "__n").filter(equal).select(*df.columns)


def size_of(df: DataFrame, cols: Sequence[str]) -> Column:
    """Bytes that a row takes before encoding: 8 for a value of fixed width, the length of a text, 1 a null."""
    total = F.lit(0)
    for c in cols:
        width = F.octet_length(c) if df.schema[c].dataType.typeName() == "string" else F.lit(8)
        total = total + F.coalesce(width, F.lit(1))
    return total.cast("bigint")


def row_hash(cols: Sequence[str]) -> Column:
    """62-bit hash of a row, such that the sum over rows doesn't depend on their order but on how often each comes."""
    return F.shiftright(F.xxhash64(*[x for c in cols for x in (F.col(c), F.isnull(F.col(c)))]), 2).cast("decimal(38,0)")


def manifest(df: DataFrame, day: Column, file: Column, size: Column, cols: Sequence[str]) -> DataFrame:
    """The list of files: (dia, arquivo, bytes, rows, checksum), one row for each file and day it holds.

    size: aggregate that gives a file's bytes. Rows without a day go to a day null, rows without a file to the file null.
    """
    return df.groupBy(day.alias("dia"), file.alias("arquivo")).agg(size.cast("bigint").alias("bytes"), F.count("*").alias("rows"), F.sum(row_hash(cols)).alias("checksum"))


def rounded(size: Column) -> Column:
    """Sizes rounded up to SIZE_BITS binary digits, so that a day has few different ones."""
    step = F.greatest(F.lit(1), F.pow(F.lit(2), F.floor(F.log2(F.greatest(size, F.lit(1)))) - (SIZE_BITS - 1)).cast("bigint"))
    return F.greatest(F.ceil(size / step) * step, F.lit(1)).cast("bigint")


def bins(files: DataFrame, file: str, target: int = TARGET_BYTES) -> DataFrame:
    """(dia, file, bytes, rows, checksum, bin): the bin of each file of a manifest, numbered from 0 within each day.

    No bin is larger than ``target`` unless a single file is. The rank of a file among those of its day and rounded size
    is found by numbering hash buckets of files: a day that holds most files doesn't end in one task.
    """
    sized = files.withColumn("__class", rounded(F.col("bytes"))).withColumn("__bucket", F.pmod(F.xxhash64(file), F.lit(512)).cast("int"))
    spread = sized.groupBy("dia", "__class", "__bucket").agg(F.count("*").alias("__n"))  # at most 512 rows a size and day
    ahead = Window.partitionBy("dia", "__class").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.withColumn("__off", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).drop("__n")
    in_bucket = Window.partitionBy("dia", "__class", "__bucket").orderBy(F.col(file).asc_nulls_first())
    ranked = sized.withColumn("__r", F.row_number().over(in_bucket) - 1)
    o = offsets.select(F.col("dia").alias("__d"), F.col("__class").alias("__c"), F.col("__bucket").alias("__b"), "__off")
    ranked = ranked.join(o, ranked["dia"].eqNullSafe(o["__d"]) & (F.col("__class") == F.col("__c")) & (F.col("__bucket") == F.col("__b"))).withColumn("__item", F.col("__r") + F.col("__off"))

    counts = spread.groupBy("dia", "__class").agg(F.sum("__n").alias("__n"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        got = first_fit_decreasing(list(zip(pdf["__class"].tolist(), pdf["__n"].tolist())), target)
        out = pd.DataFrame(got, columns=["__pc", "__from", "__many", "__bin", "__fit"])
        out["__pd"] = pdf["dia"].iloc[0]
        return out[["__pd", "__pc", "__from", "__many", "__bin", "__fit"]]

    day_type = files.schema["dia"].dataType.simpleString()
    plan = counts.groupBy("dia").applyInPandas(pack, f"__pd {day_type}, __pc bigint, __from bigint, __many bigint, __bin bigint, __fit bigint")
    placed = ranked.join(plan, ranked["dia"].eqNullSafe(plan["__pd"]) & (F.col("__class") == F.col("__pc")) & (F.col("__item") >= F.col("__from")) & (F.col("__item") < F.col("__from") + F.col("__many")))
    return placed.select("dia", file, "bytes", "rows", "checksum", (F.col("__bin") + F.floor((F.col("__item") - F.col("__from")) / F.col("__fit"))).cast("bigint").alias("bin"))


def swap_into_place(spark: SparkSession, src: str, dst: str) -> None:
    """Rename ``src`` over ``dst`` in one step of the file system; a reader sees the old file or the new one."""
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    to = jvm.org.apache.hadoop.fs.Path(dst)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration()).rename(jvm.org.apache.hadoop.fs.Path(src), to, how)


@dataclass(frozen=True)
class Compacted:
    """A committed rewrite: the kept rows, the repeats left out, and the report by day and bin."""

    rows: DataFrame
    repeats: DataFrame
    report: DataFrame
    path: str


class NotWhole(RuntimeError):
    """The rewritten files don't hold exactly the records of the manifest."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file of any file system; null where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file and move it into place in one step."""
    tmp = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.tmp"
    fs, p = _fs(spark, tmp)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    swap_into_place(spark, tmp, path)


def committed(spark: SparkSession, base: str) -> Compacted | None:
    """The rewrite that ``base``/_commit.json names; null where none was committed, so that the old files count."""
    text = read_text(spark, f"{base}/_commit.json")
    if text is None:
        return None
    said = json.loads(text)
    schema, stage = T.StructType.fromJson(said["schema"]), f"{base}/{said['version']}"
    rows = spark.read.schema(schema).parquet(f"{stage}/data")
    cols = [c for c in schema.names if c not in ("dia", "bin")]
    left_out = spark.read.schema(T.StructType([f for f in schema.fields if f.name in cols])).parquet(f"{stage}/repeats")
    report = rows.groupBy("dia", "bin").agg(F.count("*").alias("rows"), F.sum(size_of(rows, cols)).alias("bytes"), F.countDistinct("_metadata.file_path").alias("files"))
    return Compacted(rows, left_out, report, base)


def _rewritten(df: DataFrame, day: Column, file: Column, listed: DataFrame, left_out: DataFrame | None, record: str | None, base: str, target: int) -> Compacted:
    """Manifest, bins, rewrite, check and commit of ``df``; the rows of ``left_out`` go to the repeats."""
    spark = df.sparkSession
    cols = df.columns
    stage = f"{base}/v-{uuid.uuid4().hex}"
    listed.write.parquet(f"{stage}/manifest")
    frozen = spark.read.schema(listed.schema).parquet(f"{stage}/manifest")
    bins(frozen, "arquivo", target).write.parquet(f"{stage}/bins")
    placed = spark.read.parquet(f"{stage}/bins")
    (left_out if left_out is not None else df.limit(0)).write.parquet(f"{stage}/repeats")
    gone = spark.read.schema(df.schema).parquet(f"{stage}/repeats")
    where = placed.select(F.col("dia").alias("__d"), F.col("arquivo").alias("__p"), "bin")

    def in_bins(rows: DataFrame, f: Column) -> DataFrame:
        keyed = rows.withColumn("dia", day).withColumn("__f", f)
        return keyed.join(where, keyed["dia"].eqNullSafe(F.col("__d")) & keyed["__f"].eqNullSafe(F.col("__p")), "left").drop("__d", "__p", "__f")

    kept = in_bins(df, file)
    if record is not None:
        kept = kept.join(gone.select(F.col(record).alias("__gone")).distinct(), F.col(record) == F.col("__gone"), "left_anti")
    kept.repartition("dia", "bin").sortWithinPartitions("dia", "bin").write.partitionBy("dia", "bin").parquet(f"{stage}/data")
    now = spark.read.schema(kept.schema).parquet(f"{stage}/data")
    # each bin must hold what its files held, less the rows left out of them
    h, none = row_hash(cols), F.lit(0).cast("decimal(38,0)")
    have = now.select("dia", "bin", F.lit(1).cast("bigint").alias("n"), h.alias("h"), F.lit(1).alias("kept"), F.lit(0).alias("gone"))
    if record is not None:
        have = have.unionByName(in_bins(gone, file).select("dia", "bin", F.lit(1).cast("bigint").alias("n"), h.alias("h"), F.lit(0).alias("kept"), F.lit(1).alias("gone")))
    want = placed.select("dia", "bin", (-F.col("rows")).alias("n"), (none - F.col("checksum")).cast("decimal(38,0)").alias("h"), F.lit(0).alias("kept"), F.lit(0).alias("gone"))
    sums = have.unionByName(want).groupBy("dia", "bin").agg(F.sum("n").alias("n"), F.sum("h").alias("h"), F.sum("kept").alias("kept"), F.sum("gone").alias("gone"))
    said = sums.agg(F.count_if((F.col("n") != 0) | (F.col("h") != 0)), F.sum("kept"), F.sum("gone"), F.count_if(F.col("kept") > 0)).first()
    if said[0]:
        raise NotWhole(f"{base}: {said[0]} bins don't hold the records of their files")
    replace_text(spark, f"{base}/_commit.json", json.dumps({"version": stage.rsplit("/", 1)[1], "rows": int(said[1] or 0), "repeats": int(said[2] or 0), "bins": int(said[3]), "schema": json.loads(kept.schema.json())}))
    return committed(spark, base)


def compact(df: DataFrame, day: Column, file: str, record: str, same: Sequence[str], name: str, root: str | None = None, target: int = TARGET_BYTES) -> Compacted:
    """Rewrite the small files of ``df`` (column ``file`` names each row's) into well-sized ones per day.

    day: the date that a row's output directory stands for. record: number of the row, by which the first of repeated
    rows (equal in ``same``, nulls equal) is kept. A file's size is that of its values before encoding. The result lies
    under ``root``/``name``: manifest/, bins/, data/dia=…/bin=… with one file for each bin, repeats/ with the rows left
    out, and ``_commit.json``, which is moved into place last; ``committed`` finds the rewrite by it, and none means that
    the old files count. Raises NotWhole where a bin's count or checksum differs, and then commits nothing.

    Empty input commits an empty result. Columns named dia or bin in the input are kept under their names with an
    underscore before.
    """
    for clash in ("dia", "bin"):
        if clash in df.columns:
            df = df.withColumnRenamed(clash, f"_{clash}")
            same = [f"_{c}" if c == clash else c for c in same]
    cols = df.columns
    listed = manifest(df, day, F.col(file), F.sum(size_of(df, cols)), cols)
    return _rewritten(df, day, F.col(file), listed, repeats(df, record, same), record, f"{root or shared_dir(df.sparkSession)}/{name}", target)


def compact_directory(spark: SparkSession, path: str, out: str, target: int = TARGET_BYTES) -> DataFrame:
    """Rewrite a directory of Parquet files into files of about ``target`` bytes under ``out``; returns the new rows.

    The same steps as ``compact``: the manifest is the list of files with their lengths on disk, rows and checksums; files
    that come later aren't part of it and stay out. All rows are kept, repeats too. Readers find the rewrite by
    ``committed``. Raises NotWhole where a bin's count or checksum differs, and then commits nothing.
    """
    df = spark.read.parquet(path)
    cols = df.columns
    files = df.select(*cols, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__size"))
    listed = manifest(files, F.lit(0), F.col("__file"), F.max("__size"), [*cols, "__file"])
    return _rewritten(files.drop("__size"), F.lit(0), F.col("__file"), listed, None, None, out, target).rows.select(*cols)
