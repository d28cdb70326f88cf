import random

import numpy as np

from erario.llm import subjects

AREAS = {"saude": ("hospital vacina enfermeiro remedio clinica".split(), "Saúde"), "obras": ("concreto asfalto viga telhado pedreiro".split(), "Obras e infraestrutura"), "esporte": ("gol atleta piscina torneio bola".split(), "Esporte")}
FRAMES = ["O pedido abrange {} e {} na unidade.", "Registra-se que {} chegou com {}.", "Pede-se {} e {} até o fim do mês."]
NOISE = ["O prazo vence em breve.", "Endereço: rua do hospital velho, 12.", "A nota foi anexada aos autos."]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        mine = rng.sample(sorted(AREAS), rng.choice([1, 1, 2]))
        text = []
        for a in mine:
            text += [rng.choice(FRAMES).format(*rng.sample(AREAS[a][0], 2)) for _ in range(3)]
        text += rng.sample(NOISE, rng.randint(0, 3))
        rng.shuffle(text)
        out.append((i, " ".join(text), mine))
    return out


def fixture(spark, docs, labelled):
    rng = random.Random(9)
    d = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in docs], "doc_id bigint, text string, assunto string, areas string")
    rows = []
    for i, _, mine in docs[:labelled]:
        for a in mine:
            rows.append((i, rng.choice([a, a.upper(), f" {a} ", AREAS[a][1]]), "z"))
    rows += [(1, None, "z"), (None, "saude", "z"), (2, "???", "z"), rows[0]] if rows else []
    lab = spark.createDataFrame(rows, "doc_id bigint, assunto string, text string")
    ar = spark.createDataFrame([(a, n, "d") for a, (_, n) in AREAS.items()], "assunto string, nome string, descricao string")
    return d, lab, ar


def test_held_out_documents_get_their_areas(spark):
    docs = corpus()
    got = {}
    for r in subjects.subjects(*fixture(spark, docs, 250)).collect():
        got.setdefault(r["doc_id"], set()).add(r["assunto"])
    held = docs[250:]
    assert sum(got.get(i, set()) == set(mine) for i, _, mine in held) >= 0.95 * len(held)


def test_passing_mentions_blanks_and_long_texts(spark):
    docs = corpus()
    extra = [(1000, NOISE[1], []), (1001, None, []), (1002, " ", []), (1003, "", []), (1004, NOISE[0] * 3000 + " Pede-se bola e piscina até o fim do mês.", ["esporte"]), (1005, "Registra-se que VACINA chegou com REMÉDIO.", ["saude"])]
    got = {}
    for r in subjects.subjects(*fixture(spark, docs + extra, 300)).collect():
        got.setdefault(r["doc_id"], set()).add(r["assunto"])
    assert {i: got.get(i, set()) for i, _, _ in extra} == {i: set(m) for i, _, m in extra}


def test_without_labels_or_documents(spark):
    docs = corpus(20)
    assert subjects.subjects(*fixture(spark, docs, 0)).count() == 0
    assert subjects.subjects(*fixture(spark, [], 0)).count() == 0


def test_leaves_are_named_by_their_terms():
    docs = corpus(300)
    areas = sorted(AREAS)
    tree = subjects.fit([t for _, t, _ in docs], [[areas.index(a) for a in m] for _, _, m in docs], areas)
    report = subjects.leaves(tree)
    named = report[report.assuntos == "saude"]
    words = set(" ".join(named.termos).replace(",", " ").split())
    assert words & set(AREAS["saude"][0])
    assert (np.linalg.norm(tree.centroid.astype("float32"), axis=1) < 1.01).all()
