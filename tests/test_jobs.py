import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from erario.__main__ import main
from erario.ml import anomaly, forecast, jobs, tracking
from erario.operators.lake import Lake
from erario.plans import gold, maintenance, results, serve
from erario.sources import batches
from erario.streaming import incremental as inc


def said(capsys):
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_gold_is_stored_and_read_pruned(spark, data, tmp_path, capsys):
    root = f"file://{tmp_path}/lake"
    assert main(["gold", "--data", data, "--lake", root, "--select", "fo,te,dim_orgao"], spark) == 0
    assert set(said(capsys)) == {"fato_ordem_bancaria", "dim_tempo", "dim_orgao"}
    lake = Lake(spark, root)
    frames = gold.stored(lake)
    body = serve.BODIES["q03_last_payment"]
    q = serve.run(body, frames)(spark)
    assert q.collect() == serve.run(body)(spark, data).collect()
    read = {frozenset(x.split(":")[0] for x in y.split("ReadSchema: struct<")[1].split(">")[0].split(",")) for y in q._jdf.queryExecution().executedPlan().toString().split("\n") if "ReadSchema" in y}
    assert read == {frozenset({"sk_tempo", "data"}), frozenset({"sk_tempo", "flag_cancelada"})}
    n = gold.build(spark, data, lake, F.lit("2026-01-02 03:04:05").cast("timestamp"), ["og"])
    assert lake.read("gold.dim_orgao").select("gerado_em").distinct().count() == 1 and n["dim_orgao"] == lake.read("gold.dim_orgao").count()


def test_models_are_run_kept_and_recorded(spark, tmp_path):
    lake, bundle = Lake(spark, f"file://{tmp_path}/lake"), f"file://{tmp_path}/m/forest.json"
    rows = [(str(i), 2024, 100.0 + i, i % 2, 1, 0, 0) for i in range(60)] + [("x", 2024, 9e6, 1, 0, 0, 1)]
    f = spark.createDataFrame(rows, "id_contrato_origem string, ano int, valor double, emergencia int, status_VIGENTE int, status_ENCERRADO int, status_RESCINDIDO int")
    assert tracking.previous_mean(lake, jobs.SCORES) is None
    assert isinstance(jobs.run_anomaly(spark, lake, f, bundle, 30), list)
    assert lake.read(jobs.SCORES).orderBy(F.desc("score_anomalia")).first()["id_contrato_origem"] == "x"
    assert tracking.previous_mean(lake, jobs.SCORES) is not None
    trees, features, about = tracking.load_forest(spark, bundle)
    again = anomaly.raw_scores(f, features, trees).orderBy(F.desc("bruto")).first()
    assert again["id_contrato_origem"] == "x" and about["run_id"]
    runs = lake.read(tracking.RUNS)
    assert {r["tipo"] for r in runs.collect()} == {"param", "metrica", "tag", "artefato", "estado"}
    with pytest.raises(ValueError):
        tracking.load_quantiles(spark, bundle)
    with pytest.raises(FileNotFoundError):
        tracking.load_forest(spark, bundle + "x")
    with pytest.raises(ZeroDivisionError), tracking.Run(lake, "m", "r9"):
        1 / 0
    assert "falhou" in lake.read(tracking.RUNS).filter("run_id = 'r9'").first()["texto"]


def test_forecast_run(spark, tmp_path):
    lake, bundle = Lake(spark, f"file://{tmp_path}/lake"), f"file://{tmp_path}/q.json"
    rows = [(b, y, q, 100.0 * q + y, 90.0 if y > 2023 else None, 80.0 if y > 2023 else None, 5.0, 1, None if (y, q) == (2025, 4) else 100.0 * q) for b in "AB" for y in (2023, 2024, 2025) for q in (1, 2, 3, 4)]
    panel = spark.createDataFrame(rows, "codigo string, ano int, trimestre int, pago double, lag_1 double, lag_4 double, ativo double, eleicao int, alvo double")
    jobs.run_forecast(spark, lake, panel, bundle, [forecast.Params(trees=3), forecast.Params(trees=5)])
    assert lake.read(jobs.FORECASTS).filter("not is_backtest").count() == 2
    models, features, _ = tracking.load_quantiles(spark, bundle)
    assert set(models) == set(forecast.QUANTILES) and features == forecast.FEATURES
    assert lake.read(tracking.RUNS).filter("tipo = 'metrica' and chave like 'perda_%'").count() == 2


def test_a_collector_keeps_its_state_after_success_only(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    events = [("a", "2026-01-01 10:00:00"), ("b", "2026-01-01 11:00:00")]
    read = lambda since: spark.createDataFrame(events, "evento string, timestamp_evento string").filter(F.lit(since).isNull() | (F.col("timestamp_evento") >= F.lit(since)))
    assert inc.collect(lake, "ssh", read, "ops.sessoes") == 2
    assert inc.collect(lake, "ssh", read, "ops.sessoes") == 0
    events.append(("c", "2026-01-01 11:00:00"))

    def broken(since):
        raise OSError

    with pytest.raises(OSError):
        inc.collect(lake, "ssh", broken, "ops.sessoes")
    assert inc.watermark(lake, "coletor.ssh") == "2026-01-01 11:00:00"
    assert inc.collect(lake, "ssh", read, "ops.sessoes") == 1 and lake.read("ops.sessoes").count() == 3
    assert inc.watermark(lake, "coletor.audit") is None


def test_upkeep_goes_on_after_a_failure(spark, tmp_path, capsys):
    lake = Lake(spark, f"file://{tmp_path}")
    lake.replace("a", spark.range(3).select(F.col("id"), F.lit("2020-01-01").cast("date").alias("d")))
    lake.append("a", spark.sql("select 9L as id, date'2026-01-01' as d"))
    got = maintenance.run(lake, [maintenance.Upkeep("b"), maintenance.Upkeep("a", 1, None, "nada", 3), maintenance.Upkeep("a", 1, None, "d", 30)], F.lit("2026-01-10").cast("timestamp"), 0)
    assert got["a"] == "ok" and lake.read("a").count() == 1 and len(lake.log("a")) == 1
    assert maintenance.run(lake, [maintenance.Upkeep("a", 1, None, "nada", 3)])["a"] != "ok"
    assert main(["maintenance", "--lake", f"file://{tmp_path}", "--table", "a"], spark) == 0 and said(capsys) == {"a": "ok"}


def test_results_are_kept_for_a_while(spark):
    now, made = [0.0], []
    kept = results.Kept(300, lambda: now[0])
    make = lambda: made.append(1) or len(made)
    assert [kept.get("q", make), kept.get("q", make)] == [1, 1]
    now[0] = 300.0
    assert kept.get("q", make) == 2
    got = results.query(spark, "select cast(1.5 as decimal(5,2)) as v, :x as x", {"x": "d'Ávila"})
    assert got.v[0] == 1.5 and isinstance(got.v[0], float) and got.x[0] == "d'Ávila"
    with pytest.raises(OverflowError):
        results.query(spark, "select * from range(10)", most=9)


def test_ingest_validate_and_silver_commands(spark, tmp_path, capsys):
    class H(BaseHTTPRequestHandler):
        def do_GET(self):
            n = int(self.path.split("page=")[1].split("&")[0])
            body = json.dumps({"summary": {"total_pages": 2}, "data": [{"id": str(n), "ano": 2026, "dataemissao": f"2026-07-0{n} 00:00:00.000"}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    root, lake = f"file://{tmp_path}/raw", f"file://{tmp_path}/lake"
    assert main(["ingest", "--url", f"http://127.0.0.1:{server.server_port}/", "--root", root, "--source", "empenhos", "--date", "2026-07-15", "--day", "dataemissao", "--lake", lake], spark) == 0
    assert said(capsys) == {"registros": 2, "data_maxima": "2026-07-02", "paginas": 2, "marca": "2026-07-02"}
    server.shutdown()
    assert main(["silver", "--root", root, "--lake", lake, "--date", "2026-07-15"], spark) == 0
    assert said(capsys) == {"empenhos": 2}
    assert main(["validate", "--root", root, "--date", "2026-07-15"], spark) == 1 and "erro" in said(capsys)
    assert main(["counts", "--lake", lake, "--date", "2026-07-15", "--counts", '{"empenhos": 2}'], spark) == 0


def test_batches_at_any_depth_and_empty_extracts(spark, tmp_path):
    root = f"file://{tmp_path}"
    batches.write_array(spark, [{"id": 1, "d": None}], f"{root}/s/a/b/c/data_extracao=2026-01-01/p.json")
    assert [r["id"] for r in batches.read_batch(spark, root, "s", "2026-01-01").collect()] == [1]
    batches.write_batch(spark.createDataFrame([], "id int"), root, "vazio", "2026-01-01", None)
    assert (tmp_path / "vazio/data_extracao=2026-01-01" / batches.EMPTY).read_text() == "[]"
    assert batches.read_batch(spark, root, "vazio", "2026-01-01") is None


def test_quality_and_report_commands(spark, data, tmp_path, capsys):
    lake = f"file://{tmp_path}/lake"
    code = main(["quality", "--data", data, "--lake", lake], spark)
    assert code in (0, 1) and Lake(spark, lake).exists("audit.avisos")
    said(capsys)
    (tmp_path / "t.txt").write_text("Nada a relatar: R$ 3,00.")
    assert main(["report", "--data", data, "--text", str(tmp_path / "t.txt"), "--out", str(tmp_path / "r.md")], spark) == 0
    assert said(capsys) == {"sem_apoio": [3.0]}
