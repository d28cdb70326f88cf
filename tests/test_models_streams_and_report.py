import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from erario.ml import anomaly, forecast
from erario.operators.lake import Lake
from erario.plans import report
from erario.streaming import incremental as inc


def test_watermarks_never_go_back(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    assert inc.watermark(lake, "a") is None
    assert inc.advance(lake, "a", None) is None
    assert inc.advance(lake, "a", "2026-07-10") == "2026-07-10"
    assert inc.advance(lake, "a", "2026-07-01") == "2026-07-10"
    assert inc.advance(lake, "a", None) == "2026-07-10"
    assert inc.watermark(lake, "a") == "2026-07-10"


def test_start_dates():
    assert inc.start_date(["2026-07-10"]) == "2026-07-03"
    assert inc.start_date(["2026-07-10", "2026-06-30"]) == "2026-06-23"  # tables read together share the older mark
    assert inc.start_date([None, "2026-06-30"], "2026-01-08") == "2026-01-01"
    assert inc.start_date([None]) == inc.FIRST_DATE
    assert inc.start_date(["ontem"]) == "ontem"


def test_replayed_stream_leaves_the_table_as_it_is(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    src = str(tmp_path / "in")
    schema = "id int, v string, m date"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(src)
    import datetime

    d = datetime.date(2026, 7, 10)
    put([(1, "a", d), (2, "b", d)])
    run = lambda c: inc.merge_stream(spark.readStream.schema(schema).json(src), lake, "t", ["id"], "m", f"{tmp_path}/{c}").awaitTermination()
    run("c1")
    put([(1, "c", d + datetime.timedelta(1))])
    run("c1")
    want = {1: "c", 2: "b"}
    assert {r["id"]: r["v"] for r in lake.read("t").collect()} == want
    run("c2")  # all files again
    assert {r["id"]: r["v"] for r in lake.read("t").collect()} == want


def test_windowed_counts_are_a_stream(spark, tmp_path):
    src = str(tmp_path / "e")
    spark.sql("select timestamp'2024-01-01 01:00:00' as ts, 'x' as k union all select timestamp'2024-01-01 05:00:00', 'x'").write.parquet(src)
    s = inc.windowed_counts(spark.readStream.schema("ts timestamp, k string").parquet(src), "ts", "k")
    q = s.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["n"] for r in spark.table("w").collect()] == [2]
    assert inc.chain(spark, [("a", lambda: 1), ("b", lambda: 2)]) == ["a", "b"]


def test_outlier_scores_highest(spark):
    rows = [(f"c{i}", 10_000.0 + 100 * i, float(i % 3)) for i in range(39)] + [("fora", 5_000_000.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double, w double")
    f = anomaly.train(df, "k", ["v", "w"], trees=60)
    out = anomaly.scored(df, ["v", "w"], f).orderBy(F.desc("score_anomalia")).collect()
    assert out[0]["k"] == "fora" and out[0]["flag_anomalia"]
    assert all(0 <= r["score_anomalia"] <= 1 for r in out)
    again = anomaly.train(df.repartition(3), "k", ["v", "w"], trees=60)
    assert all((a == b).all() for a, b in zip(f, again))  # the same forest however the rows lie


def test_contamination_flags_about_that_share(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame(pd.DataFrame({"k": [str(i) for i in range(400)], "v": rng.normal(size=400), "w": rng.normal(size=400)}))
    f = anomaly.train(df, "k", ["v", "w"], trees=50)
    out = anomaly.scored(df, ["v", "w"], f, 0.1)
    assert 0.05 <= out.agg(F.avg(F.col("flag_anomalia").cast("int"))).first()[0] <= 0.15
    assert anomaly.train(df.limit(0), "k", ["v"], trees=5) == []


def test_trees_get_about_their_rows(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("v"))
    sizes = [t[0, 4] for t in anomaly.train(df, "k", ["v"], trees=50)]
    assert len(sizes) == 50 and abs(np.mean(sizes) - anomaly.ROWS) < 15 and np.std(sizes) < 40


def test_score_summary(spark):
    s = anomaly.summary(spark.createDataFrame([(x,) for x in (0.1, 0.5, 0.72, 0.85, 0.91, 0.96, 1.0)], "score_anomalia double"))
    assert (s["acima_0.70"], s["acima_0.90"], s["acima_0.95"]) == (5, 3, 2)
    assert anomaly.summary(spark.createDataFrame([], "score_anomalia double"))["parte_0.90"] == 0.0
    assert anomaly.alerts({"n": 5.0, "p50": 0.5, "p99": 0.5, "media": 0.5}, 0.2) and not anomaly.alerts({"n": 5.0, "p50": 0.1, "p99": 0.5, "media": 0.2}, 0.2)


def test_folds_train_on_earlier_quarters_only():
    qs = [(a, q) for a in (2023, 2024) for q in (1, 2, 3, 4)]
    fs = forecast.folds(qs, 3)
    assert [t for _, t in fs] == [(2024, 1), (2024, 2), (2024, 3)]  # the last quarter is held out
    assert all(max(tr) < te for tr, te in fs)
    assert forecast.folds([(2024, 1)]) == []


def test_quantiles_are_ordered_and_not_negative():
    a, b, c = forecast.ordered(np.array([-5.0, 3.0]), np.array([-1.0, 2.0]), np.array([4.0, 1.0]))
    assert (a >= 0).all() and (b >= a).all() and (c >= b).all()


def test_boosting_learns_a_step():
    x = np.linspace(0, 10, 200)[:, None]
    y = np.where(x[:, 0] > 5, 10.0, 1.0)
    m = forecast.fit(x, y, 0.5)
    assert abs(forecast.predict(m, np.array([[1.0]]))[0] - 1) < 0.5 and abs(forecast.predict(m, np.array([[9.0]]))[0] - 10) < 0.5
    assert forecast.predict(m, np.array([[np.nan]])).shape == (1,)


@pytest.fixture(scope="module")
def panel(spark):
    rows = []
    for b in ("A", "B", "C"):
        v = [(y, q, 10_000.0 + 500 * i) for i, (y, q) in enumerate((y, q) for y in (2023, 2024, 2025) for q in (1, 2, 3, 4))]
        for i, (y, q, x) in enumerate(v):
            rows.append((b, y, q, x, v[i - 1][2] if i else None, v[i - 4][2] if i >= 4 else None, 100_000.0, 1, v[i + 1][2] if i + 1 < len(v) else None))
    return spark.createDataFrame(rows, "codigo string, ano int, trimestre int, pago double, lag_1 double, lag_4 double, ativo double, eleicao int, alvo double")


def test_forecasts_and_backtests_are_disjoint(spark, panel):
    f = forecast.forecasts(spark, panel, forecast.Params(trees=10))
    rows = f.collect()
    fwd = {(r["codigo"], r["ano_previsto"], r["trimestre_previsto"]) for r in rows if not r["is_backtest"]}
    back = {(r["codigo"], r["ano_previsto"], r["trimestre_previsto"]) for r in rows if r["is_backtest"]}
    assert fwd == {(b, 2026, 1) for b in "ABC"} and len(back) == 6 and not fwd & back
    assert all(0 <= r["p10"] <= r["p50"] <= r["p90"] for r in rows)
    q = forecast.quality(f)
    assert q["n"] == 6 and isinstance(forecast.alerts(q, 0.0), list)
    assert forecast.forecasts(spark, panel.limit(0)).count() == 0


def test_tuning_picks_the_least_loss(spark, panel):
    best, means = forecast.tune(spark, panel.toPandas(), [forecast.Params(trees=0), forecast.Params(trees=20)], 2)
    assert len(means) == 2 and best == [forecast.Params(trees=0), forecast.Params(trees=20)][int(np.argmin(means))]


def test_report_flags_invented_amounts(spark, data, tmp_path):
    good = report.run(spark, data, lambda p: "\n".join(x for x in p.split("\n")), 3, 3)
    assert good.unsupported == [] and "R$ " in good.prompt
    bad = report.run(spark, data, lambda p: "Foram R$ 123.456.789.012,34", 3, 3)
    assert bad.unsupported == [123456789012.34]
    report.save(bad, str(tmp_path / "r.md"))
    assert "sem apoio" in (tmp_path / "r.md").read_text()
    assert "R$ 123.456.789.012,34" in (tmp_path / "r.md").read_text()
    assert report.unsupported(spark, "", [1.0]) == []
