from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from erario.operators import quality
from erario.operators import relational as rel
from erario.operators.lake import Lake


def test_dedup_takes_the_same_row_every_time(spark):
    df = spark.createDataFrame([(1, 2026, 100.0), (1, 2026, 200.0), (2, 2026, None), (None, 2026, 5.0), (None, 2026, 6.0)], "id int, ano int, valor double")
    a, b = (sorted(rel.dedup(df.repartition(n), ["id", "ano"]).collect(), key=str) for n in (1, 4))
    assert a == b and len(a) == 3
    assert [r["valor"] for r in rel.dedup(df, ["id", "ano"], ["valor"]).filter("id = 1").collect()] == [200.0]
    assert rel.dedup(df.limit(0), ["id"]).count() == 0


M = "codigo int, ano int, titulo string, m date"


def rows(df):
    return sorted((r["codigo"], r["titulo"], r["m"]) for r in df.collect())


def day(n):
    return date(2026, 7, n)


def test_merge_is_idempotent_and_order_safe(spark):
    old = spark.createDataFrame([(1, 2026, "velho", day(10)), (2, 2026, "B", day(10)), (3, 2026, "sem marca", None)], M)
    new = spark.createDataFrame([(1, 2026, "novo", day(20)), (3, 2026, "C", day(15)), (4, 2026, "D", day(20)), (2, 2026, "perde", None)], M)
    once = rel.merge(old, new, ["codigo", "ano"], "m")
    want = [(1, "novo", day(20)), (2, "B", day(10)), (3, "C", day(15)), (4, "D", day(20))]
    assert rows(once) == want
    assert rows(rel.merge(once, new, ["codigo", "ano"], "m")) == want
    stale = spark.createDataFrame([(1, 2026, "velho", day(10))], M)
    assert rows(rel.merge(once, stale, ["codigo", "ano"], "m")) == want


def test_merge_with_null_keys_new_columns_and_drift(spark):
    old = spark.createDataFrame([(None, "a", day(1))], "k int, v string, m date")
    new = spark.createDataFrame([(None, 7, day(2), "x"), ("oops", 8, day(2), "y")], "k string, v int, m date, extra string")
    got = rel.merge(old, rel.dedup(new.filter("k is null"), ["k"]), ["k"], "m").collect()
    assert [(r["k"], r["v"], r["extra"]) for r in got] == [(None, "7", "x")]
    assert [r["k"] for r in rel.align(new, old).collect()] == [None, None]  # what doesn't fit is null


def test_scd2(spark):
    s = "k string, nome string, tipo string"
    now = lambda n: F.lit(f"2026-07-0{n} 00:00:00").cast("timestamp")
    v1 = rel.scd2(None, spark.createDataFrame([("1", "A", None), ("2", "B", "PJ")], s), "k", ["nome", "tipo"], now(1))
    src = spark.createDataFrame([("1", "A", "PF"), ("3", "C", "PF")], s)
    v2 = rel.scd2(v1, src, "k", ["nome", "tipo"], now(2))
    got = sorted((r["k"], r["tipo"] or "", r["valido_ate"] is None) for r in v2.collect())
    assert got == [("1", "", False), ("1", "PF", True), ("2", "PJ", True), ("3", "PF", True)]
    v3 = rel.scd2(v2, src, "k", ["nome", "tipo"], now(3))
    assert sorted(map(str, v3.collect())) == sorted(map(str, v2.collect()))


def test_asof_falls_back_to_the_oldest_version(spark):
    v = spark.createDataFrame([("a", datetime(2024, 1, 10, 5), datetime(2024, 6, 1), "v1"), ("a", datetime(2024, 6, 1), None, "v2"), ("b", datetime(2024, 3, 1, 1), datetime(2024, 3, 1, 9), "curta"), ("b", datetime(2024, 3, 1, 9), None, "b2")], "k string, de timestamp, ate timestamp, sk string")
    f = spark.createDataFrame([(1, "a", date(2023, 1, 1)), (2, "a", date(2024, 1, 10)), (3, "a", date(2024, 6, 1)), (4, "a", date(2024, 5, 31)), (5, "x", date(2024, 1, 1)), (6, None, date(2024, 1, 1)), (7, "b", date(2024, 3, 1)), (8, "a", None)], "id int, k string, d date")
    got = {r["id"]: r["sk"] for r in rel.asof_version(f, "k", "d", v, "k", "de", "ate", ["sk"]).collect()}
    assert got == {1: "v1", 2: "v1", 3: "v2", 4: "v1", 5: None, 6: None, 7: "b2", 8: "v1"}


def test_overlap_bounds(spark):
    p = spark.createDataFrame([("o", date(2024, 1, 1), date(2024, 3, 31)), ("p", date(2024, 1, 1), date(2024, 3, 31))], "k string, a date, b date")
    s = spark.createDataFrame([("o", None, date(2024, 1, 1), 1.0), ("o", date(2024, 3, 31), None, 2.0), ("o", date(2024, 4, 1), None, 4.0), ("o", None, date(2023, 12, 31), 8.0), ("o", None, None, None)], "k string, s date, e date, v double")
    assert {r["k"]: r["x"] for r in rel.overlap_sum(p, ["k"], "a", "b", s, "s", "e", "v", "x").collect()} == {"o": 3.0, "p": 0.0}


def test_tail_cut(spark):
    df = spark.createDataFrame([(2024, m, n) for m, n in ((1, 2), (2, 10), (3, 11), (4, 4), (5, 12), (6, 3), (7, 1))], "ano int, mes int, n int")
    got = sorted(r["mes"] for r in rel.tail_cut(df, ["ano", "mes"], "n").collect())
    assert got == [1, 2, 3, 4, 5, 6]  # median 4: only the last month is below 2 and at the end
    one = spark.createDataFrame([(2024, 1, 0)], "ano int, mes int, n int")
    assert rel.tail_cut(one, ["ano", "mes"], "n").count() == 1
    assert rel.tail_cut(one.limit(0), ["ano", "mes"], "n").count() == 0


def test_mode_histogram_scaling_and_one_hot(spark):
    df = spark.createDataFrame([("a", "y", 1.0), ("a", "x", 0.0), ("a", None, 0.049999), ("b", "z", 0.05)], "k string, c string, s double")
    assert {r["k"]: r["c"] for r in rel.mode_per_group(df, ["k"], "c").collect()} == {"a": "x", "b": "z"}
    assert {r["faixa"]: r["linhas"] for r in rel.histogram(df, "s", 20).collect()} == {19: 1, 0: 2, 1: 1}
    assert [r["o"] for r in rel.min_max(spark.createDataFrame([(3.0,), (None,)], "v double"), "v", "o").collect()] == [0.0, None]
    assert {r["c"] for r in rel.top_or_other(df, "c", 1).collect()} == {"x", "OUTROS"}
    assert [r["p_x"] for r in rel.one_hot(df, "c", ["x"], "p").collect()] == [0, 1, 0, 0]
    assert round(df.agg(F.avg(rel.pinball(F.lit(10.0), F.lit(8.0), 0.9)).alias("l")).first()["l"], 6) == 1.8


def test_lookup_keeps_facts(spark):
    f, d = spark.createDataFrame([("a",), (None,), ("z",)], "k string"), spark.createDataFrame([("a", 1)], "k string, v int")
    for limit in (0, 10):
        assert sorted(str(r["v"]) for r in rel.lookup(f, d, ["k"], limit).collect()) == ["1", "None", "None"]


def test_lake_lifecycle(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    schema = "id int, v string, m date"
    assert lake.read("silver.t", spark.createDataFrame([], schema).schema).count() == 0
    with pytest.raises(FileNotFoundError):
        lake.read("silver.t")
    assert lake.merge("silver.t", spark.createDataFrame([(1, "a", day(1)), (1, "b", day(2)), (2, "c", day(1))], schema), ["id"], "m") == 2
    first = lake.log("silver.t")[0]["version"]
    assert lake.merge("silver.t", spark.createDataFrame([(1, "stale", day(1), 9)], schema + ", extra int"), ["id"], "m") == 2
    assert {r["id"]: r["v"] for r in lake.read("silver.t").collect()} == {1: "b", 2: "c"}
    assert "extra" in lake.read("silver.t").columns
    assert lake.append("silver.t", spark.createDataFrame([(3, "d", day(3))], schema)) == 1
    assert lake.append("silver.t", spark.createDataFrame([], schema)) == 0
    assert lake.read("silver.t", version=first).count() == 2  # time travel
    assert lake.replace_distinct("gold.u", spark.createDataFrame([(1,), (1,)], "x int")) == 1
    assert lake.tables() == ["gold.u", "silver.t"]
    assert lake.snapshots("silver.t").count() == 3
    assert lake.retain("silver.t", "m", 0, F.lit("2026-07-02 12:00:00").cast("timestamp")) == 1
    lake.compact("silver.t", 1)
    gone = lake.expire("silver.t", 0)
    assert first in gone and len(lake.log("silver.t")) == 1
    assert lake.read("silver.t").count() == 1


def test_readers_keep_the_old_version_when_a_write_fails(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    lake.replace("t", spark.createDataFrame([(1,)], "x int"))
    with pytest.raises(Exception):
        lake.replace("t", spark.createDataFrame([("x",)], "x string").select(F.col("x").cast("int")))
    assert lake.read("t").count() == 1


def test_checks_and_enforcement(spark):
    df = spark.createDataFrame([(1, "PF"), (1, "??"), (None, None)], "id int, tipo string")
    c = [quality.Check("u", "warn", quality.unique(df, ["id"])), quality.Check("n", "warn", quality.not_null(df, "id")), quality.Check("a", "warn", quality.accepted(df, "tipo", ["PF"])), quality.Check("r", "warn", quality.related(df, "id", df.limit(0), "id"))]
    assert {r["teste"]: r["violacoes"] for r in quality.run(c).collect()} == {"u": 1, "n": 1, "a": 1, "r": 2}
    assert len(quality.enforce(c)) == 4
    assert quality.warning_history(c, F.current_timestamp()).count() == 4
    with pytest.raises(quality.FailedCheck):
        quality.enforce([*c, quality.Check("e", "error", quality.not_null(df, "id"))])


def test_batch_validation(spark):
    ok = spark.createDataFrame([(0, 0, "2026-01-01", False)], "id int, ano int, dataemissao string, f boolean")
    assert quality.validate_batch(ok, ["id", "ano", "dataemissao", "f"], 1, "s") == {"registros": 1}
    assert quality.validate_batch(ok.limit(0), ["id"], 0, "s") == {"registros": 0}
    for bad, req, least in ((None, ["id"], 0), (ok, ["x"], 0), (ok, ["id"], 2), (ok.withColumn("dataemissao", F.lit("  ")), ["dataemissao"], 0), (ok.withColumn("id", F.lit(None).cast("int")), ["id"], 0)):
        with pytest.raises(quality.InvalidBatch):
            quality.validate_batch(bad, req, least, "s")
    many = spark.range(200).select(F.when(F.col("id") == 199, F.lit(None)).otherwise(F.col("id")).alias("id"), F.lit("g").alias("g"), F.col("id").alias("o"))
    with pytest.raises(quality.InvalidBatch):
        quality.validate_batch(many, ["id"], 0, "s")
    assert quality.batch_sample(many, 2, 0, "g", "o").count() == 4


def test_appends_and_merges_write_only_what_they_must(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    schema = "id int, ano int, v string, m date"
    lake.merge("t", spark.createDataFrame([(i, 2020 + i % 3, "a", day(1)) for i in range(30)], schema), ["id", "ano"], "m", ["ano"])
    before = {x["path"]: x["rows"] for x in lake.leaves("t")}
    assert len(before) == 3 and sum(before.values()) == 30
    assert lake.merge("t", spark.createDataFrame([(0, 2020, "b", day(2)), (99, 2020, "n", day(2)), (7, None, "x", day(2))], schema), ["id", "ano"], "m") == 32
    after = {x["path"] for x in lake.leaves("t")}
    assert len(after & set(before)) == 2  # the years that the batch has no row of are as they were
    assert {r["v"] for r in lake.read("t").filter("id = 0").collect()} == {"b"}
    assert lake.merge("t", spark.createDataFrame([(7, None, "y", day(3))], schema), ["id", "ano"], "m") == 32  # a null partition
    kept = {x["path"] for x in lake.leaves("t")}
    assert lake.append("t", spark.createDataFrame([(100, 2021, "z", day(3))], schema)) == 1
    assert kept < {x["path"] for x in lake.leaves("t")} and lake.read("t").count() == 33
    assert lake.add_columns("t", spark.createDataFrame([], "v string, w double").schema.fields) == ["w"]
    assert {x["path"] for x in lake.leaves("t")} > kept and lake.read("t").filter("w is null").count() == 33
    assert lake.compact("t", 1, "ano") == 33 and len(lake.leaves("t")) == 4
    assert not lake.ensure("t", lake.read("t").schema) and lake.ensure("a.b.c.d", lake.read("t").schema, ["ano"])
    assert lake.tables() == ["a.b.c.d", "t"] and lake.read("a.b.c.d").count() == 0
    assert lake.append_stamped("n", spark.createDataFrame([(1,)], "x int")) == 1 and "coletado_em" in lake.read("n").columns


def test_expiry_leaves_a_writer_at_work_alone(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    for v in (1, 2):
        lake.replace("t", spark.createDataFrame([(v,)], "x int"))
    at_work = lake._write("t", spark.createDataFrame([(3,)], "x int"), [])  # not committed yet
    assert len(lake.expire("t", 0)) == 1
    assert (tmp_path / "t" / at_work[0]["path"]).exists() and lake.read("t").first()["x"] == 2
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("p-")]) == 2


def test_dedup_reads_wanted_columns_only(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(1, 2, "a", "x", "y"), (1, 3, "b", "x", "y")], "k int, o int, v string, w string, z string").write.parquet(p)
    one = rel.dedup(spark.read.parquet(p), ["k"], ["o"], ["v"], tie=False)
    assert one.columns == ["k", "v"] and one.first()["v"] == "b"
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "w:string" not in plan and "z:string" not in plan


def test_pinball_of_unknown_values_is_unknown(spark):
    df = spark.createDataFrame([(10.0, 8.0), (8.0, 10.0), (None, 8.0), (8.0, None)], "y double, p double")
    assert [r["l"] for r in df.select(F.round(rel.pinball(F.col("y"), F.col("p"), 0.9), 6).alias("l")).collect()] == [1.8, 0.2, None, None]
