import json

import pytest
from pyspark.sql import functions as F

from erario.functions import rules
from erario.operators.quality import InvalidBatch
from erario.operators.lake import Lake
from erario.plans import silver
from erario.sources import batches, paged, relational, telemetry


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value,want",
    [("15/07/2026", "2026-07-15"), ("2026-07-21T00:00:00.000-03:00", "2026-07-21"), ("2026-07-15 00:00:00.000", "2026-07-15"), ("hoje", "hoje"), (None, None), ("99/99/2026", "2026-99-99"), ("", "")],
)
def test_dates_as_text(spark, value, want):
    assert one(spark, value, rules.iso_day_text) == want


def test_bad_values_become_null(spark):
    assert one(spark, "99/99/2026", rules.as_day) is None
    assert one(spark, "não é número", rules.money) is None
    assert str(one(spark, "1200.50", rules.money)) == "1200.50"
    with pytest.raises(Exception):
        one(spark, "x%", rules.percent)


@pytest.mark.parametrize("value,want", [("1GiB", 1024**3), ("1.5MiB", 1572864), ("2GB", 2 * 1024**3), ("512", 512), ("garbage", 0), ("", 0), ("7 KB", 7168)])
def test_sizes(spark, value, want):
    assert one(spark, value, rules.size_bytes) == want


def test_tax_ids(spark):
    df = spark.createDataFrame([("", "123.456.789-01"), ("12.345.678/0001-95", None), (None, "123"), (None, None)], "a string, b string")
    d = rules.first_digits(F.col("a"), F.col("b"))
    assert [(r["d"], r["k"]) for r in df.select(d.alias("d"), rules.taxpayer_kind(d).alias("k")).collect()] == [("12345678901", "PF"), ("12345678000195", "PJ"), ("123", "INVALIDO"), (None, None)]


def test_amounts_and_their_support(spark):
    df = spark.createDataFrame([("Saldo de R$ 48.310,07 após R$ 25.", [48310.12]), ("R$ 7.700,45", [31.0, 6.5]), ("", [2.0])], "t string, a array<double>")
    got = df.select(rules.amounts(F.col("t")).alias("v"), rules.unsupported(rules.amounts(F.col("t")), F.col("a")).alias("u")).collect()
    assert [r["v"] for r in got] == [[48310.07, 25.0], [7700.45], []]
    assert [r["u"] for r in got] == [[25.0], [7700.45], []]


def test_display_rules(spark):
    assert one(spark, 80412.6, rules.reais, "double") == "R$ 80.412,60"
    assert one(spark, None, rules.reais, "double") == "não informado"
    assert one(spark, -2_500_000.0, rules.reais_scaled, "double") == "R$ -2,50 mi"
    assert one(spark, 3e9, rules.reais_scaled, "double") == "R$ 3,00 bi"
    assert [one(spark, s, rules.risk_class, "double") for s in (0.69, 0.7, 0.85, 0.86, None)] == ["Baixo", "Médio", "Médio", "Alto", None]
    assert one(spark, "03/09/25 08:04:41.902", rules.audit_time) == "2025-03-09 08:04:41.902"
    assert one(spark, "R$ 1", rules.markdown_safe) == "R\\$ 1"
    df = spark.createDataFrame([(2024, 4), (2025, 4), (2024, 1)], "a int, q int")
    a, b = rules.quarter_bounds(F.col("a"), F.col("q"))
    r = df.select(a.cast("string").alias("a"), b.cast("string").alias("b"), rules.election_flag(F.col("a"), F.col("q")).alias("e")).collect()
    assert (r[0]["a"], r[0]["b"], [x["e"] for x in r]) == ("2024-10-01", "2024-12-31", [0, 1, 1])


def test_batches_round_trip(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = spark.createDataFrame([(1, "2022-01-10"), (2, "2022-01-20"), (3, "2022-02-05"), (4, None)], "id int, dataemissao string")
    batches.write_batch(df, root, "empenhos", "2026-07-15", F.col("dataemissao"))
    assert len(batches.batch_dirs(spark, root, "empenhos", "2026-07-15")) == 3  # two months and one flat
    assert batches.read_batch(spark, root, "empenhos", "2026-07-15").count() == 4
    many = spark.range(50).select("id", F.lit("2022-03-01").alias("dia")).coalesce(1)  # many records in one file
    batches.write_batch(many, root, "muitos", "2026-07-15", F.col("dia"))
    assert batches.read_batch(spark, root, "muitos", "2026-07-15").count() == 50
    assert batches.read_batch(spark, root, "empenhos", "2026-07-16") is None
    assert batches.extract_summary(df, "dataemissao") == {"registros": 4, "data_maxima": "2022-02-05"}
    batches.write_batch(df.limit(0), root, "contratos", "2026-07-15", None)
    assert len(batches.batch_dirs(spark, root, "contratos", "2026-07-15")) == 1
    assert batches.read_batch(spark, root, "contratos", "2026-07-15") is None
    assert batches.batch_dirs(spark, root, "nada", "2026-07-15") == []


def test_json_arrays_in_both_layouts(spark, tmp_path):
    for p, rows in (("contratos/data_extracao=2026-07-15/page_0001.json", [{"id": 1}]), ("contratos/ano=2026/mes=06/data_extracao=2026-07-15/page_0001.json", [{"id": 2, "x": "a"}, {"id": 3}]), ("contratos/data_extracao=2026-07-14/a.json", [{"id": 9}])):
        f = tmp_path / p
        f.parent.mkdir(parents=True)
        f.write_text(json.dumps(rows))
    root = f"file://{tmp_path}"
    df = batches.read_batch(spark, root, "contratos", "2026-07-15")
    assert sorted(r["id"] for r in df.collect()) == [1, 2, 3]
    files = [x for d in batches.batch_dirs(spark, root, "contratos", "2026-07-15") for x in batches.batch_files(spark, d)]
    assert len(files) == 2 and batches.sample_batches(spark, files, 8).count() == 3


def test_paging_stops_and_complains():
    answers = {"1": {"sumary": {"total_pages": 2}, "data": [{"id": 1}]}, "2": {"summary": {"total_pages": 2}, "results": [{"id": 2}, {"id": 3}]}}
    get = lambda url, p: (200, {}, json.dumps(answers[p["page"]]))
    assert [(n, len(r)) for n, r in paged.pages(get, "u", {})] == [(1, 1), (2, 2)]
    with pytest.raises(paged.PageError):
        list(paged.pages(lambda u, p: (200, {}, "{}"), "u", {}))
    calls = []

    def busy(url, p):
        calls.append(1)
        return (429, {"Retry-After": "0"}, "") if len(calls) < 3 else (200, {}, '{"summary": {"total_pages": 1}}')

    assert paged.page_count(paged.get_page(busy, "u", {}, 0)) == 1 and len(calls) == 3
    with pytest.raises(paged.PageError):
        paged.get_page(lambda u, p: (500, {}, ""), "u", {}, 0)


def test_paged_source_reads_pages_as_partitions(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class H(BaseHTTPRequestHandler):
        def do_GET(self):
            n = self.path.split("page=")[1].split("&")[0]
            body = json.dumps({"summary": {"total_pages": 3}, "data": [{"id": int(n)}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(paged.PagedSource)
    df = spark.read.format("erario_paged").option("url", f"http://127.0.0.1:{server.server_port}/").load()
    assert sorted((r["pagina"], r["registro"]) for r in df.collect()) == [(i, json.dumps({"id": i})) for i in (1, 2, 3)]
    server.shutdown()


def test_text_ranges_leave_the_last_day_to_the_next_run(spark, tmp_path):
    p = str(tmp_path / "e")
    spark.createDataFrame([("2026-01-30 00:00:00.000",), ("2026-01-31 00:00:00.000",), ("2026-01-31",)], "dataemissao string").write.parquet(p)
    assert relational.read_range(spark, "empenhos", "2026-01-01", "2026-01-31", parquet=p).count() == 2
    with pytest.raises(ValueError):
        relational.read_range(spark, "segredos", "a", "b", parquet=p)


def lines(spark, *v):
    return spark.createDataFrame([(x,) for x in v], "value string")


def test_telemetry_readers(spark):
    c = telemetry.container_stats(lines(spark, '{"Name":"a","CPUPerc":"3.50%","MemUsage":"512MiB / 6GiB","MemPerc":"8.33%"}', "x", '{"Name":"b","CPUPerc":"","MemUsage":"","MemPerc":"0%"}')).collect()
    assert [tuple(r) for r in c] == [("a", 3.5, 512 << 20, 6 << 30, 8.33), ("b", 0.0, 0, 0, 0.0)]
    d = telemetry.disk_usage(lines(spark, "Mounted 1B-blocks Used Use%", "/ 500000000000 250000000000 50%", "/run 188000 1 1%", "quebrada 1")).collect()
    assert [(r["ponto"], r["percentual"]) for r in d] == [("/", 50.0)]
    s = telemetry.ssh_sessions(lines(spark, "2026-07-26T10:00:00+00:00 h sshd[12]: Accepted publickey for ana from 10.0.0.1 port 22 ssh2", "2026-07-26T10:00:00+00:00 h sshd[12]: pam_unix(sshd:session): session opened for user ana(uid=1)", "2026-07-26T11:00:00+00:00 h sshd[12]: pam_unix(sshd:session): session closed for user ana"))
    assert [(r["evento"], r["usuario"], r["origem_ip"], r["sessao_pid"]) for r in s.collect()] == [("login", "ana", "10.0.0.1", "12"), ("logout", "ana", None, "12")]


def test_audit_blocks(spark, tmp_path):
    head = "type=SYSCALL msg=audit(03/09/25 08:04:41.902:77) : auid={} uid={} comm={}"
    text = "\n----\n".join([f"type=PROCTITLE msg=audit(03/09/25 08:04:41.902:77) : proctitle=du -sh dados\n{head.format('carla', 'root', 'du')}", head.format("davi", "davi", "less"), head.format("unset", "root", "cron")])
    (tmp_path / "a.log").write_text(text)
    got = telemetry.audit_commands(telemetry.read_blocks(spark, str(tmp_path / "a.log"))).collect()
    assert [(r["usuario"], r["executado_como"], r["comando"]) for r in got] == [("carla", "root", "du -sh dados"), ("davi", "davi", "less")]
    assert got[0]["timestamp_evento"] == "2025-03-09 08:04:41.902"


def test_silver_pipeline(spark, tmp_path):
    root, lake = f"file://{tmp_path}/raw", Lake(spark, f"file://{tmp_path}/lake")

    def put(source, day, rows):
        f = tmp_path / f"raw/{source}/data_extracao={day}/a.json"
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(json.dumps(rows))

    put("contratos", "2026-07-15", [{"id": "1", "data_assinatura": "15/07/2026", "plain_cpf_cnpj_financiador": "123.456.789-01", "valor_contrato": "1200.50", "calculated_valor_pago": "não é número", "cod_gestora": "9"}])
    put("empenhos", "2026-07-15", [{"id": "1", "ano": 2022, "dataemissao": "2026-07-15 00:00:00.000", "valor": 1.5}] * 2)
    assert silver.run(spark, lake, root, "2026-07-15") == {"contratos": 1, "empenhos": 1}
    c = lake.read("silver.contratos").first()
    assert (str(c["data_assinatura"]), c["cnpj_cpf"], c["tipo_credor"], str(c["valor_contrato"]), c["calculated_valor_pago"], c["ano"], c["mes"]) == ("2026-07-15", "12345678901", "PF", "1200.50", None, 2026, 7)
    e = lake.read("silver.empenhos").first()
    assert (e["ano"], e["mes"], e["valor"]) == (2022, 7, 1.5)
    put("empenhos", "2026-07-10", [{"id": "1", "ano": 2022, "dataemissao": "2026-07-01", "valor": 9.0}])
    silver.run(spark, lake, root, "2026-07-10")  # an older batch, late
    assert [r["valor"] for r in lake.read("silver.empenhos").collect()] == [1.5]
    with pytest.raises(InvalidBatch):
        silver.validate(spark, root, "2026-07-15")
    assert silver.record_counts(lake, "2026-07-15", {"contratos": 1, "empenhos": 2}) == 2
    assert silver.record_counts(lake, "2026-07-15", {"contratos": 5}) == 2
