from datetime import date, datetime

from pyspark.sql import functions as F

from erario.functions.keys import key_number, plain_key, plain_number
from erario.operators.history import creditor_versions
from erario.operators.orphans import composite_number, orphans, runs, within_runs

DIM = "sk_credor string, cnpj_cpf string, nome string, tipo string, historico_infringement boolean, valido_de timestamp_ntz, valido_ate timestamp_ntz, versao_atual boolean, carregado_em timestamp_ntz, extra string"
SNAP = "data_snapshot date, cnpj_cpf string, nome string, tipo string, historico_infringement boolean, carregado_em timestamp_ntz, de string"


def versions(spark, dim, snap):
    v = creditor_versions(spark.createDataFrame(dim, DIM), spark.createDataFrame(snap, SNAP))
    return sorted((r["cnpj_cpf"], r["valido_de"], r["valido_ate"], r["nome"], r["tipo"], r["versao_atual"], r["aberta_por"]) for r in v.collect())


def d(m, day=1):
    return date(2025, m, day)


def t(m, h=0):
    return datetime(2025, m, 1, h)


def base(key="1", nome="Ana", tipo="PF", current=True):
    return ("sk" + key, key, nome, tipo, False, datetime(2021, 1, 1), None if current else datetime(2022, 1, 1), current, datetime(2021, 1, 2), "x")


def test_versions_open_only_on_change(spark):
    snap = [
        (d(2), "1", "  ANA ", "PF", False, t(2), ""),  # case and blanks are no change
        (d(3), "1", "Ana", None, False, t(3), ""),  # null is a value
        (d(3), "1", "Ana", "PF", False, t(3, 5), ""),  # corrected: the row loaded last counts
        (d(4), "1", "Ana B", "PF", True, t(4), ""),  # two attributes change at once
        (d(6), "1", "Ana B", "PF", True, t(6), ""),  # absence in May closed nothing
        (d(6), "1", "Ana B", "PF", True, t(6), ""),
        (d(5), "9-9", "Neu", "PJ", None, t(5), ""),  # first sight
        (d(6), "99", None, "PJ", None, t(6), ""),
        (d(6), "sem", "x", "PF", False, t(6), ""),  # no digits: no entity
    ]
    got = versions(spark, [base(), base("1", "Velha", current=False)], snap)
    assert {(x[0], x[1].date(), x[3], x[5]) for x in got} == {
        ("1", date(2021, 1, 1), "Velha", False), ("1", date(2021, 1, 1), "Ana", False), ("1", d(4), "ANA B", True), ("99", d(5), "NEU", False), ("99", d(6), None, True),
    }
    assert len(got) == 5
    current = [x for x in got if x[3] == "Ana"][0]
    assert current[2].date() == d(4)  # closed where the next one opens
    neu = [x for x in got if x[3] == "NEU"][0]
    assert (neu[2].date(), neu[6]) == (d(6), "snapshot")


def test_versions_of_empty_tables(spark):
    assert versions(spark, [], []) == []
    assert len(versions(spark, [base()], [])) == 1
    assert len(versions(spark, [], [(d(2), "7", "N", "PF", False, None, "")])) == 1


def test_change_and_return_open_two_versions(spark):
    snap = [(d(m), "1", n, "PF", False, t(m), "") for m, n in ((2, "Ana"), (3, "Bia"), (4, "Ana"))]
    assert [x[3] for x in versions(spark, [base()], snap)] == ["Ana", "BIA", "ANA"]


def test_keys_are_plain(spark):
    r = spark.createDataFrame([(" 007 ",), ("000",), ("  ",), (None,), ("A0b ",)], "k string").select(plain_number(F.col("k")).alias("n"), plain_key(F.col("k")).alias("k"))
    assert [(x["n"], x["k"]) for x in r.collect()] == [("7", "007"), ("0", "000"), (None, None), (None, None), ("a0b", "a0b")]


def test_runs_compress_consecutive_numbers(spark):
    df = spark.createDataFrame([("g", i) for i in [*range(100), 200, 201, 5, 7]] + [("h", 100), ("h", None)], "grupo string, numero bigint")
    got = runs(df, "grupo", "numero").collect()
    cover = sorted((r["grupo"], i) for r in got for i in range(r["inicio"], r["fim"] + 1))
    assert cover == sorted({("g", i) for i in [*range(100), 200, 201]} | {("h", 100)})
    assert len(got) <= 3 + 4  # a range boundary may cut a run


REFS = "grupo string, chave string, em timestamp_ntz, rotulo string, motivo string, quando int"
PARENTS = "grupo string, chave string, de timestamp_ntz, ate timestamp_ntz, fim string"


def lost(spark, refs, parents):
    r = spark.createDataFrame([(*x, "velho", 1) for x in refs], REFS).withColumn("numero", key_number(F.col("chave")))
    p = spark.createDataFrame([(*x, "z") for x in parents], PARENTS).withColumn("numero", key_number(F.col("chave")))
    out = orphans(r, p)
    assert "quando" in out.columns
    return sorted((x["rotulo"], x["motivo"]) for x in out.collect())


def test_orphans_by_time(spark):
    parents = [("g", "1", t(2), t(4)), ("g", "1", t(6), None), ("g", "2", None, None), ("g", "9", t(1), t(2)), ("g", "9", t(1), t(2)), ("h", "3", t(1), None), ("g", None, t(1), None), ("g", "f" * 32, t(3), None)]
    refs = [
        ("g", "1", t(1), "cedo"), ("g", "1", t(2), "no dia"), ("g", "1", t(3), "dentro"), ("g", "1", t(4), "no fim"), ("g", "1", t(5), "no meio"), ("g", "1", t(7), "de novo"),
        ("g", "2", t(1), "sempre"), ("g", "3", t(1), "outro grupo"), ("g", "5", t(1), "nada"), ("g", "9", None, "sem hora"), ("g", "1", None, "sem hora aberta"), ("g", None, t(1), "sem chave"), (None, "1", t(1), "sem grupo"),
        ("g", "f" * 32, t(2), "hex cedo"), ("g", "f" * 32, t(3), "hex"), ("g", "f" * 15 + "0" * 17, t(3), "mesmo número, outra chave"), ("g", "nenhum texto", t(3), "texto"),
    ]
    assert lost(spark, refs, parents) == sorted([("cedo", "fora_do_prazo"), ("no fim", "fora_do_prazo"), ("no meio", "fora_do_prazo"), ("outro grupo", "inexistente"), ("nada", "inexistente"), ("sem hora", "fora_do_prazo"), ("hex cedo", "fora_do_prazo"), ("mesmo número, outra chave", "inexistente"), ("texto", "inexistente")])


def test_orphans_of_a_hot_key_and_empty_sides(spark):
    refs = [("g", "1", t(1 + i % 12), f"r{i}") for i in range(600)]
    assert len(lost(spark, refs, [("g", "1", t(6), None)])) == 250
    assert len(lost(spark, refs, [])) == 600
    assert lost(spark, [], [("g", "1", t(6), None)]) == []


def test_composite_numbers_keep_distance(spark):
    r = spark.createDataFrame([(2024, "10"), (2024, "11"), (2025, "10"), (2024, "x"), (None, "1")], "a int, k string").select(composite_number(F.col("a"), F.col("k")).alias("n")).collect()
    assert r[1]["n"] - r[0]["n"] == 1
    assert len({x["n"] for x in r}) == 5


def test_the_run_before_decides_what_is_beyond(spark):
    parents = spark.createDataFrame([("g", i) for i in [*range(10, 20), 30]] + [("h", 5)], "grupo string, numero bigint")
    asked = spark.createDataFrame([("g", n, "x") for n in (9, 10, 15, 19, 20, 29, 30, 31)] + [("h", 5, "y"), ("h", 6, "y"), ("i", 5, "y")], "grupo string, numero bigint, dentro string")
    want = {("g", 10), ("g", 15), ("g", 19), ("g", 30), ("h", 5)}
    lines = runs(parents, "grupo", "numero")
    for held in (10**6, 0):  # held in every task, and walked
        got = within_runs(asked.withColumn("outro", F.lit(1)), lines, held).collect()
        assert len(got) == 11 and {(r["grupo"], r["numero"]) for r in got if r["dentro"]} == want and all(r["outro"] == 1 for r in got)


def test_only_references_within_a_run_meet_the_parents(spark, monkeypatch):
    from erario.operators import orphans as module

    monkeypatch.setattr(module, "runs", lambda parents, group, number: spark.createDataFrame([("g", 1, 3)], "grupo string, inicio bigint, fim bigint"))
    refs = [("g", "2", t(3), "dentro"), ("g", "9", t(3), "além")]
    assert lost(spark, refs, [("g", "2", t(1), None), ("g", "9", t(1), None)]) == [("além", "inexistente")]
