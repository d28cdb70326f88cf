import json
import random
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from erario.operators import compaction
from erario.operators.compaction import NotWhole, bins, committed, compact, compact_directory, first_fit_decreasing, repeats, rounded

SCHEMA = "registro_id bigint, nome string, v double, em timestamp, arquivo string, dia string, bin int"


def one_by_one(items, capacity):
    open_, out = [], []
    for s in sorted(items, reverse=True):
        for i, used in enumerate(open_):
            if used + s <= capacity:
                open_[i] += s
                out.append((s, i))
                break
        else:
            open_.append(s)
            out.append((s, len(open_) - 1))
    return sorted(out)


@given(st.lists(st.integers(1, 60), max_size=50), st.integers(5, 50))
def test_grouped_packing_is_first_fit_decreasing(items, capacity):
    got = [(size, b + k // fit) for size, _, many, b, fit in first_fit_decreasing(list(Counter(items).items()), capacity) for k in range(many)]
    assert sorted(got) == one_by_one(items, capacity)


def frame(spark):
    rows = [(1, "a", 0.0, "2024-01-01 00:00:01", "f1"), (2, "a", -0.0, "2024-01-01 00:00:01", "f2"), (3, "b", None, "2024-01-01 10:00:00", "f2"), (4, "b", None, "2024-01-01 10:00:00", "f3"), (5, None, None, None, None), (6, None, None, None, "f4"), (None, "a", 0.0, "2024-01-01 00:00:01", "f1"), (7, "a" * 100_000, 1.0, "2024-01-02 00:00:00", "f5")]
    return spark.createDataFrame([(*r[:3], None, r[4], "x", 1, r[3]) for r in rows], "registro_id bigint, nome string, v double, e timestamp, arquivo string, dia string, bin int, t string").withColumn("em", F.col("t").cast("timestamp")).drop("e", "t")


def test_repeats_take_nulls_as_equal_and_keep_the_least_number(spark):
    got = sorted(r["registro_id"] for r in repeats(frame(spark), "registro_id", ["nome", "v", "em"]).collect())
    assert got == [2, 4, 6]


def test_repeats_of_a_hot_record(spark):
    df = spark.range(2000).select(F.col("id").alias("r"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("x"))
    assert repeats(df, "r", ["x"]).count() == 667 + 1 - 1  # 0, 3, 6 … and 1 are equal; the first of them stays


def test_compact_commits_all_records_once(spark, tmp_path):
    df = frame(spark)
    c = compact(df, F.to_date("em"), "arquivo", "registro_id", ["nome", "v", "em"], "t", root=f"file://{tmp_path}")
    assert sorted(r["registro_id"] or 0 for r in c.rows.collect()) == [0, 1, 3, 5, 7]
    assert {"_dia", "_bin"} <= set(c.rows.columns)
    commit = json.loads((tmp_path / "t" / "_commit.json").read_text())
    assert (commit["rows"], commit["repeats"]) == (5, 3)
    again = compact(df, F.to_date("em"), "arquivo", "registro_id", ["nome", "v", "em"], "t", root=f"file://{tmp_path}")
    assert json.loads((tmp_path / "t" / "_commit.json").read_text())["version"] != commit["version"]
    assert again.rows.count() == 5
    read = committed(spark, f"file://{tmp_path}/t")
    assert read.rows.count() == 5 and sorted(r["registro_id"] for r in read.repeats.collect()) == [2, 4, 6]
    assert committed(spark, f"file://{tmp_path}/nothing") is None
    assert sorted((str(r["dia"]), r["rows"], r["files"]) for r in again.report.collect()) == [("2024-01-01", 3, 1), ("2024-01-02", 1, 1), ("None", 1, 1)]


def test_compact_of_nothing(spark, tmp_path):
    c = compact(frame(spark).limit(0), F.to_date("em"), "arquivo", "registro_id", ["nome"], "e", root=f"file://{tmp_path}")
    assert c.rows.count() == 0 and c.repeats.count() == 0


def test_nothing_is_committed_when_rows_are_lost(spark, tmp_path, monkeypatch):
    whole = compaction.manifest
    monkeypatch.setattr(compaction, "manifest", lambda *a: whole(*a).withColumn("rows", F.col("rows") + 1))
    with pytest.raises(NotWhole):
        compact(frame(spark), F.to_date("em"), "arquivo", "registro_id", ["nome", "v", "em"], "bad", root=f"file://{tmp_path}")
    assert not (tmp_path / "bad" / "_commit.json").exists()


def test_a_bin_that_lost_a_row_to_another_is_told(spark, tmp_path, monkeypatch):
    whole = compaction.manifest

    def shifted(*a):  # the total is right, the files' own counts aren't
        m = whole(*a)
        return m.withColumn("rows", F.col("rows") + F.when(F.col("arquivo") == "f5", 1).when(F.col("arquivo") == "f1", -1).otherwise(0))

    monkeypatch.setattr(compaction, "manifest", shifted)
    with pytest.raises(NotWhole):
        compact(frame(spark), F.to_date("em"), "arquivo", "registro_id", ["nome", "v", "em"], "bad", root=f"file://{tmp_path}")


def test_tiny_files_fill_a_bin(spark):
    files = spark.range(5000).select(F.lit("d").alias("dia"), F.col("id").cast("string").alias("arquivo"), (F.col("id") % 7 + 700).alias("bytes"), F.lit(1).cast("bigint").alias("rows"), F.lit(0).alias("checksum"))
    assert bins(files, "arquivo", 1 << 27).select("bin").distinct().count() == 1
    n = spark.range(1, 3000).select(F.col("id"), rounded(F.col("id")).alias("r")).collect()
    assert all(x["id"] <= x["r"] <= x["id"] * 1.04 for x in n) and len({x["r"] for x in n}) < 32 * 12


def test_bins_respect_the_target_and_days(spark):
    rng = random.Random(3)
    files = [(f"2024-01-0{rng.randint(1, 2)}", f"f{i}", rng.choice([100, 500, 900, 5000]), 1, 0) for i in range(300)]
    df = spark.createDataFrame(files, "dia string, arquivo string, bytes bigint, rows bigint, checksum bigint")
    got = bins(df, "arquivo", target=2000).collect()
    assert len(got) == 300
    load = Counter()
    for r in got:
        load[r["dia"], r["bin"]] += r["bytes"]
    alone = {(r["dia"], r["bin"]) for r in got if r["bytes"] > 2000}
    assert all(v <= 2000 for k, v in load.items() if k not in alone)
    assert all(load[k] == 5000 for k in alone)
    assert len(load) < 200


def test_directory_of_small_files(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.range(400).repartition(40).write.parquet(src)
    new = compact_directory(spark, f"file://{src}", f"file://{out}", target=4096)
    assert new.count() == 400
    files = [p for p in (tmp_path / "out").rglob("*.parquet")]
    assert 0 < len(files) < 40
    spark.range(400, 500).write.mode("append").parquet(src)  # later files aren't in the rewrite
    assert committed(spark, f"file://{out}").rows.count() == 400
