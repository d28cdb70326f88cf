import itertools

import pytest

from erario.llm import names

T = frozenset("comercio alimentos locacao veiculos servicos limpeza artes graficas tecnologia informacao terraplenagem".split())
W = names.Words(T, frozenset("antonio isabel joao jose luiz maria pedro raimundo rosangela".split()), frozenset({"cutrotaca"}), {"bebel": "isabel", "toninho": "antonio"})


@pytest.mark.parametrize(
    "a,b,want",
    [
        ("Raimundo João Bramitalo Drebrubugo", "RAIMUNDO JOAO BARMITALO DREBRUBUGO", True),
        ("Drebrubugo, Raimundo João Bramitalo", "Raimundo J. Bramitalo de Drebrubugo", True),
        ("Bebel Maria Pububape de Bavidredri", "Isabel Maria Pububape Bavidredri", True),
        ("Raimundo Bramitalo Drebrubugo", "Raimundo João Bramitalo Drebrubugo", True),
        ("Maria Rosângela L. da Pabomoze", "Maria Rosângela Luzajuvu Pabomoze", True),
        ("Maria Pububape de Bavidredri", "Isabel Pububape de Bavidredri", False),  # relatives
        ("Luiz Pedro Bramitalo Drebrubugo", "Luiz José Bramitalo Drebrubugo", False),
        ("José C. de Cutrotaca", "José Calanedro Cutrotaca", False),  # too frequent a surname for an initial
        ("Dejevude Drudupate Loc. de Veíc. S.A.", "DEJEVUDE DRUDUPATE LOCAÇÃO DE VEÍCULOS S/A", True),
        ("Comércio de Alimentos Mutroganu Badrelefa - ME", "Mutroganu Badrelefa Com. de Alimentos Ltda. EPP", True),
        ("D. Tucofedri Serviços de Limpeza ME", "Dragujage Tucofedri Serviços de Limpeza ME", True),
        ("Dragujagetucofedri serv. limpeza me", "Dragujage Tucofedri Serviços de Limpeza ME", True),
        ("Dragujage Tucofedri ME", "Dragujage Tucofedri Serviços de Limpeza ME", True),
        ("Dragujage Tucofedri Artes Gráficas ME", "Dragujage Tucofedri Serviços de Limpeza ME", False),  # sister companies
        ("Bemudufu Tucofedri Serviços de Limpeza ME", "Dragujage Tucofedri Serviços de Limpeza ME", False),
        ("Graf. Bubejuda Trutamaza S/A", "Bubejuda Trutamaza Artes Gráficas Ltda", True),
        ("Ana Silva", "Ana Silva Ltda", False),
    ],
)
def test_parts_decide(a, b, want):
    assert names.same(names.form(a), names.form(b), W) is want
    assert names.same(names.form(b), names.form(a), W) is want


def test_blocks_of_a_frequent_ngram_meet_all(spark, monkeypatch):
    monkeypatch.setattr(names, "BLOCK_ROWS", 5)
    forms = spark.createDataFrame([(i, f"zebracutrotaca {chr(97 + i % 26) * 7}") for i in range(26)], "id bigint, forma string")
    pairs = {(r["a"], r["b"]) for r in names.similar_pairs(forms, 0.05).collect()}
    assert len(pairs) == 26 * 25 // 2


def test_average_linkage(spark):
    links = [(1, 2, 1.0), (2, 3, 1.0), (1, 3, 1.0), (3, 4, 1.0), (7, 8, 1.0)]
    g = {r["id"]: r["grupo"] for r in names.average_linkage(spark.createDataFrame(links, "a bigint, b bigint, s double"), 0.5).collect()}
    assert g[7] == g[8] != g[1] and set(g) == {1, 2, 3, 4, 7, 8}
    # 4 hangs on 3 only: it joins 3 first or stays out of the clique, never pulls all four together by a third of the links
    assert len({g[i] for i in (1, 2, 3, 4)}) == 2
    assert names.average_linkage(spark.createDataFrame([], "a bigint, b bigint, s double")).count() == 0


DIM = "sk_credor string, cnpj_cpf string, nome string, tipo string, valido_de timestamp, versao_atual boolean, carregado_em timestamp, forma string, entidade string, id string"


def creditors(spark, rows):
    return spark.createDataFrame([("s", k, n, None, None, cur, None, "x", "y", "z") for k, n, cur in rows], DIM)


def test_pairs_with_copies_nulls_and_history(spark):
    rows = [("1", "Dragujage Tucofedri Serviços de Limpeza ME", True), ("2", "DRAGUJAGE TUCOFEDRI SERVIÇOS DE LIMPEZA ME", True), ("3", "Dragujage Tucofdri Serviços de Limpeza - ME", True), ("3", "Outra Coisa Velha Ltda", False), ("4", "Vobuzeti Nanodrefi Terraplenagem Ltda", True), ("5", None, True), (None, "X", True), (" ", "Y", True), ("6", " .,", True), ("2", "DRAGUJAGE TUCOFEDRI SERVIÇOS DE LIMPEZA ME", True)]
    got = sorted((r["cnpj_cpf_a"], r["cnpj_cpf_b"]) for r in names.pairs(creditors(spark, rows)).collect())
    assert got == [("1", "2"), ("1", "3"), ("2", "3")]
    e = {r["cnpj_cpf"]: (r["entidade"], r["formas"]) for r in names.entities(creditors(spark, rows)).collect()}
    assert e["1"] == e["2"] == e["3"] and e["1"][1] == 2 and set(e) == {"1", "2", "3", "4"}


def test_no_creditors(spark):
    assert names.pairs(creditors(spark, [])).count() == 0
    assert names.form("A" * 100_000) == "a" * 100_000


def test_whole_vectors_are_compared(spark, monkeypatch):
    import math
    import random

    rng = random.Random(4)
    syl = ["ba", "dre", "vi", "zu", "cotra", "ge", "lo", "pi", "nu", "fa"]
    fs = sorted({" ".join("".join(rng.choice(syl) for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(1, 3))) for _ in range(200)})
    monkeypatch.setattr(names, "BLOCK_ROWS", 7)
    forms = spark.createDataFrame(list(enumerate(fs)), "id bigint, forma string")
    gs = [set(names.grams(f)) for f in fs]
    df = {g: sum(g in s for s in gs) for s in gs for g in s}
    w = {g: math.log((len(fs) + names.SATURATED) / max(n, names.SATURATED)) ** 2 * (names.WHOLE if len(g) < names.GRAM else 1) for g, n in df.items()}
    norm = [math.sqrt(sum(w[g] ** 2 for g in s)) for s in gs]
    cos = {(i, j): sum(w[g] ** 2 for g in gs[i] & gs[j]) / (norm[i] * norm[j]) for i, j in itertools.combinations(range(len(fs)), 2)}
    for least in (0.1, 0.25, 0.5):
        rows = names.similar_pairs(forms, least).collect()
        got = [(r["a"], r["b"]) for r in rows]
        assert all(abs(r["s"] - cos[r["a"], r["b"]]) < 1e-9 for r in rows)
        assert len(got) == len(set(got)) and {p for p, c in cos.items() if c >= least + 1e-6} <= set(got) <= {p for p, c in cos.items() if c >= least - 1e-6}


def people(shift=0):
    surnames = [f"{a}{b}{c} {c}{a}{b}" for a in ("zebra", "cotra", "vidre") for b in ("lupi", "nufa", "goda") for c in ("mizu", "pevo", "trofa")]
    given = ["Antônio", "Maria", "Benedito"]
    return [(f"{shift}{i:03d}", f"{given[i % 3]} {s}", True) for i, s in enumerate(surnames)]


def test_short_forms_are_learnt_from_the_names(spark):
    rows = people() + [(f"1{k}", n.replace("Antônio", "Toninho"), True) for k, n, _ in people()[:9:3]] + [("9", "Zzoninho Outro Nome", True)]
    rows += [(f"2{k}", n.replace("Maria", "José"), True) for k, n, _ in people()[1:4:3]]  # a relative, once
    got = names.short_forms(names.current_names(creditors(spark, rows)).select("forma").distinct(), frozenset({"antonio", "maria", "benedito"}), len(rows))
    assert got == {"toninho": "antonio"}
    assert names.grams("toninho x", got) == names.grams("antonio x")


def test_the_nearest_of_each_name(spark):
    p = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.5), (1, 4, 0.5), (2, 3, 0.3), (3, 4, 0.2)], "a bigint, b bigint, s double")
    assert sorted((r["a"], r["b"]) for r in names.nearest(p, 1).collect()) == [(1, 2), (1, 3), (1, 4)]
    assert names.nearest(p, 5).count() == 5


def test_linkage_goes_by_cosines_and_must_end(spark):
    links = [(1, 2, 0.9), (2, 3, 0.3), (1, 3, 0.05)]
    df = spark.createDataFrame(links, "a bigint, b bigint, s double")
    g = {r["id"]: r["grupo"] for r in names.average_linkage(df, 0.2).collect()}
    assert g[1] == g[2] != g[3]
    assert len({r["grupo"] for r in names.average_linkage(df, 0.15).collect()}) == 1
    with pytest.raises(RuntimeError):
        names.average_linkage(df, 0.15, rounds=1)


def test_pairs_of_a_large_entity_are_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(names, "BLOCK_ROWS", 4)
    rows = [(f"{i:02d}", "Dragujage Tucofedri Serviços de Limpeza ME", True) for i in range(15)]
    got = [tuple(r) for r in names.pairs(creditors(spark, rows)).collect()]
    assert len(got) == len(set(got)) == 105 and all(a < b for a, b in got)


def test_variant_that_shares_light_ngrams(spark):
    rows = people() + [(f"1{k}", n.replace("Antônio", "Toninho"), True) for k, n, _ in people()[:9:3]]
    rows += [("3001", "Antônio Abacadabelago Bacadafegila Zuvuzazu", True), ("3002", "Toninho A. B. Zuvuzazu", True)]
    got = {tuple(r) for r in names.pairs(creditors(spark, rows)).collect()}
    assert ("3001", "3002") in got and len(got) == 4


def shuffled(spark, make):
    """Rows of the DataFrame that ``make`` gives, and the bytes shuffled for them."""
    store = spark.sparkContext._jsc.sc().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    before = store.executorList(False).apply(0).totalShuffleWrite()
    rows = make().count()
    bus.waitUntilEmpty()
    return rows, store.executorList(False).apply(0).totalShuffleWrite() - before


def families(spark, members):
    """Forms of 10 families, each with a surname of its own."""
    rng = __import__("random").Random(1)
    fs = sorted({f"{''.join(rng.choice('bcdfgjlmnp') for _ in range(4))} {c * 3}cutro{c * 3}" for c in "qrstvwxyzh" for _ in range(members)})
    return spark.createDataFrame(list(enumerate(fs)), "id bigint, forma string").coalesce(2)


def test_pairs_that_meet_are_not_shuffled(spark):
    # four times the names are sixteen times the pairs that meet
    few, few_bytes = shuffled(spark, lambda: names.similar_pairs(families(spark, 60)))
    many, many_bytes = shuffled(spark, lambda: names.similar_pairs(families(spark, 240)))
    assert few > 10_000 and many > 12 * few
    assert many_bytes < 6 * few_bytes


def test_pairs_of_an_entity_are_not_shuffled(spark):
    rows = [(f"{i:04d}", "Dragujage Tucofedri Serviços de Limpeza ME", True) for i in range(800)]
    n, b = shuffled(spark, lambda: names.pairs(creditors(spark, rows)))
    assert n == 800 * 799 // 2 and b < n


def test_pairs_found_and_compared_at_once(spark, monkeypatch):
    monkeypatch.setattr(names, "BLOCK_ROWS", 9)
    monkeypatch.setattr(names, "MEETINGS", 50)
    forms = spark.createDataFrame([(i, names.form(n)) for i, (_, n, _) in enumerate(people() + [(k, n.replace("lupi", "lpui"), c) for k, n, c in people()[:9]])], "id bigint, forma string")
    want = names.agreeing(names.similar_pairs(forms, 0.1), forms, W).collect()
    got = names.similar_pairs(forms, 0.1, words=W).collect()
    assert sorted((r["a"], r["b"], round(r["s"], 9)) for r in got) == sorted((r["a"], r["b"], round(r["s"], 9)) for r in want) and len(got) >= 9


def test_a_group_of_postings_over_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        forms = families(spark, 7)
        got = {(r["a"], r["b"]) for r in names.similar_pairs(forms).collect()}
        fs = {r["id"]: r["forma"].split()[1] for r in forms.collect()}
        assert got == {(a, b) for a, b in itertools.combinations(sorted(fs), 2) if fs[a] == fs[b]}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
