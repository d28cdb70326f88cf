import random

from pyspark.sql import functions as F

from erario.operators.heavykeys import heavy_keys, key_profile
from erario.operators.ranges import last_before, matching_groups, running


def rows(n=3000, hot=0.4, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rng.random() < hot else rng.choice([None, "a", "b", "c"])
        out.append((k, i, rng.choice([None, 1, 2, 5])))
    rng.shuffle(out)
    return out


def test_running_totals_cross_range_boundaries(spark):
    data = rows()
    got = running(spark.createDataFrame(data, "k string, i int, v int"), "k", ["i"], "v", ranges=7).collect()
    want, n, t = {}, {}, {}
    for k, i, v in sorted(data, key=lambda r: r[1]):
        n[k] = n.get(k, 0) + 1
        t[k] = t.get(k, 0) + (v or 0)
        want[i] = (n[k], float(t[k]))
    assert {r["i"]: (r["row_in_key"], r["total_in_key"]) for r in got} == want


def test_running_on_an_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "k string, i int, v int, row_in_key string")
    out = running(df, "k", ["i"], "v")
    assert out.count() == 0
    assert out.columns == ["k", "i", "v", "row_in_key", "total_in_key"]


def test_profile_matches_group_by(spark):
    df = spark.createDataFrame(rows(), "k string, i int, v int")
    a = {r["chave"]: (r["linhas"], r["total"], r["menor"], r["maior"]) for r in key_profile(df, F.col("k"), F.col("v"), ["i"]).collect()}
    b = {r["k"]: (r["n"], r["t"], r["a"], r["b"]) for r in df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("t"), F.min("v").alias("a"), F.max("v").alias("b")).collect()}
    assert {k: tuple(map(int, v)) for k, v in a.items()} == {k: tuple(map(int, v)) for k, v in b.items()}


def test_heavy_keys_count_keyless_rows_in_the_whole(spark):
    df = spark.createDataFrame([("x", i) for i in range(4)] + [(None, i) for i in range(96)], "k string, i int")
    assert [r["chave"] for r in heavy_keys(df, F.col("k"), ["i"], 0.03).collect()] == ["x"]
    assert heavy_keys(df, F.col("k"), ["i"], 0.04).count() == 0
    assert heavy_keys(df.limit(0), F.col("k"), ["i"], 0.03).count() == 0


def test_key_of_nulls_only(spark):
    r = key_profile(spark.createDataFrame([("a", None, 1), ("a", None, 2)], "k string, v double, i int"), F.col("k"), F.col("v"), ["i"]).first()
    assert (r["linhas"], r["total"], r["menor"]) == (2, None, None)


def test_last_before_against_a_plain_walk(spark):
    rng = random.Random(5)
    data = [(rng.choice("gh"), rng.randrange(12), i, rng.choice([None, None, rng.randrange(2**60)]), rng.choice([None, rng.randrange(50)])) for i in range(800)]
    df = spark.createDataFrame(data, "g string, k int, o int, a bigint, b bigint")
    got = last_before(df, ["g", "k"], ["o"], {"a": (1, "last"), "b": (2, "max")}, ranges=9).collect()
    last, most, want = {}, {}, {}
    for g, k, o, a, b in sorted(data):
        if a is not None:
            last[g] = a
        if b is not None:
            most[g, k] = max(b, most.get((g, k), b))
        want[o] = (last.get(g), most.get((g, k)))
    assert {r["o"]: (r["a"], r["b"]) for r in got} == want


def test_matching_groups_keeps_every_pair_of_a_hot_key(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("x", 1)], "k string, i int")
    sizes = left.groupBy("k").agg(F.count("*").alias("n"), F.lit(7).alias("v"))
    assert matching_groups(left, sizes, ["k"], "n", 0.5).count() == 501


def test_states_hold_on_both_sides_of_a_union(spark):
    df = spark.range(4000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("x"))
    want = {}
    last = {}
    for r in sorted(df.collect(), key=lambda r: (r["k"], r["o"])):
        last[r["k"]] = r["x"] if r["x"] is not None else last.get(r["k"])
        want[r["o"]] = last[r["k"]]
    w = last_before(df, ["k"], ["o"], {"x": (1, "last")}, ranges=7)
    got = spark.range(500).select(F.lit(-1).cast("bigint").alias("k"), F.col("id").alias("o"), F.lit(None).cast("bigint").alias("x")).unionByName(w).filter("k >= 0").collect()
    assert {r["o"]: r["x"] for r in got} == want
    t = running(df.withColumn("v", F.lit(1)), "k", ["o"], "v", ranges=7)
    both = spark.range(10).select(F.lit(0).cast("bigint").alias("row_in_key"), F.lit(0.0).alias("total_in_key")).unionByName(t.select("row_in_key", "total_in_key")).filter("row_in_key > 0").collect()
    assert all(r["row_in_key"] == r["total_in_key"] for r in both) and len(both) == 4000
