import itertools

import numpy as np
import pytest

from erario.llm import leaks
from erario.llm.text import plain, repaired, sentences, tokens

FORMULA = "Nada mais havendo a tratar, lavrou-se o presente registro que vai rubricado em todas as folhas."
ITEM = "Pajotrigu recebeu 51 empenhos no trimestre e anulou 15 deles depois que Brufubete apontou diferença de R$ 386,78 no saldo. " + FORMULA + " O caixa de Pajotrigu abriu com R$ 346.721,29, recebeu 106 estornos de Brufubete e fechou devendo 13 reais. Em qual dos 3 meses o saldo de Pajotrigu fica abaixo de R$ 30.837,17?"
OTHER = "Zuvijigo trocou 27 fornecedores em 798 dias porque Tetevage cobrou R$ 965,14 acima da tabela. Tetevage parcelou R$ 394.196,53 em 36 vezes, mas Zuvijigo só reconheceu 57 por cento da primeira. Qual parcela cabe a Zuvijigo?"
AROUND = "O pedido abrange a merenda das creches e soma R$ 770,61. Registra-se que o diretor reuniu pais e mestres e que as aulas voltaram depois da greve. "


def case(name):
    parts = ITEM.replace(FORMULA + " ", "").split(". ")
    return {
        "whole": AROUND + ITEM + " " + AROUND,
        "part": AROUND + "deles depois que Brufubete apontou diferença de R$ 386,78 no saldo. O caixa de Pajotrigu abriu com R$ 346.721,29, recebeu 106 " + AROUND,
        "typography": AROUND + " ".join(tokens(ITEM)) + " " + AROUND,
        "capitals": (AROUND + ITEM).upper(),
        "order": AROUND + ". ".join(reversed(parts)) + AROUND,
        "words": AROUND + ITEM.replace("trimestre", "semestre").replace("estornos", "valores").replace("depois", "agora"),
        "broken": (AROUND + ITEM).encode().decode("cp1252", "replace"),
        "formula": AROUND + FORMULA + AROUND,
        "opening": AROUND + "Pajotrigu recebeu 51 empenhos no",
        "build": AROUND + ITEM.replace("Pajotrigu", "Lomenafi").replace("Brufubete", "Cadrobuju").replace("51", "77").replace("15", "22").replace("386,78", "901,12").replace("346.721,29", "118.004,50").replace("106", "233").replace("30.837,17", "77.100,02"),
        "clean": AROUND * 30,
        "long": AROUND * 2000 + ITEM + AROUND * 10,
        "empty": "", "blank": " \n ", "none": None,
    }[name]


NAMES = ["whole", "part", "typography", "capitals", "order", "words", "broken", "formula", "opening", "build", "clean", "long", "empty", "blank", "none"]
LEAKED = {"whole", "part", "typography", "capitals", "order", "words", "broken", "long"}


def run(spark, texts, items):
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "doc_id bigint, text string, item_id string, ids string")
    its = spark.createDataFrame(items, "item_id bigint, enunciado string, resposta string, text string")
    return sorted((r["doc_id"], r["item_id"]) for r in leaks.find(docs, its).collect())


def test_cases(spark):
    texts = [case(n) for n in NAMES] + [AROUND + f"Contrato {i}." for i in range(60)] + [OTHER]
    got = run(spark, texts, [(1, ITEM, "238", "x"), (2, OTHER, None, "x"), (3, None, None, "x"), (4, "  ", "y", "x"), (None, ITEM, "z", "x")])
    assert {NAMES[d] for d, k in got if k == 1} == LEAKED
    assert [d for d, k in got if k == 2] == [len(texts) - 1]


def test_nothing_to_search(spark):
    assert run(spark, [], [(1, ITEM, "238", "x")]) == []
    assert run(spark, [ITEM], []) == []
    assert run(spark, [None, ""], [(1, ITEM, "238", "x")]) == []


def test_latent_space_is_the_leading_singular_space(spark):
    rng = np.random.default_rng(1)
    topics = [rng.choice(leaks.WIDTH, 40, replace=False) for _ in range(5)]
    docs = [rng.choice(topics[i % 5], leaks.PASSAGE).astype("int32").tolist() for i in range(100)]
    words = spark.createDataFrame([(d,) for d in docs], "ids array<int>").repartition(3)
    idf, basis, values = leaks.latent_space(words, [np.array(docs[0])], rank=8)
    assert np.allclose(basis.T @ basis, np.eye(8), atol=1e-3)
    a = leaks.weighted([np.array(d) for d in [*docs, docs[0]]], idf)
    dense = np.zeros((a.rows, leaks.WIDTH), "float32")
    dense[a.row, a.word] = a.weight
    exact = np.linalg.svd(dense, compute_uv=False)
    assert np.allclose(values[:5], exact[:5], rtol=0.05)


def test_longest_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = (list(map(str, rng.integers(0, 5, rng.integers(0, 12)))) for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        got = leaks.common_words(a, b)
        assert len(got) == t[-1, -1] and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 48, 100])
def test_passages_cover_every_word(n):
    got = leaks.passages(np.arange(n))
    assert sorted({int(x) for p in got for x in p}) == list(range(n))


def test_text_forms():
    assert repaired("usuário".encode().decode("cp1252")) == "usuário"
    assert plain("<p>AÇÃO</p>").split() == ["acao"]
    assert tokens("R$ 1.234,56") == ["r", "1", "234", "56"]
    assert sentences("Um. Dois; três\n| a | b |") == ["um.", "dois;", "tres", " a ", " b "]


QUESTION = "Em qual dos 3 meses o saldo de Pajotrigu fica abaixo de R$ 30.837,17?"  # own words: a name and four numbers


def test_names_are_told_by_their_own_count(spark):
    def colliding(name):
        bucket = lambda w: leaks.buckets(np.array(leaks.hashed([w], leaks.Numbers())))[0]
        words = ("".join(x) for x in itertools.product("abcdefghij", repeat=7))
        return next(w for w in words if bucket(w) == bucket(name))

    frequent = " ".join(map(colliding, ("pajotrigu", "brufubete")))
    texts = [AROUND + QUESTION + " " + AROUND] + [AROUND + f"Contrato {i} {frequent}." for i in range(60)]
    assert run(spark, texts, [(1, ITEM, "238", "x")]) == [(0, 1)]


def test_copies_dont_make_a_name_common(spark):
    texts = [AROUND + QUESTION + " " + AROUND] * 45 + [AROUND + f"Contrato {i}." for i in range(600)]
    assert run(spark, texts, [(1, ITEM, "238", "x")]) == [(i, 1) for i in range(45)]
    away = leaks.Away({1: (ITEM, "238")})
    assert away.of(tokens(AROUND + QUESTION)) == []
    assert [away.words[i] for i in away.of(tokens("Pajotrigu " + AROUND * 3 + " Pajotrigu pediu Pajotrigu"))] == ["pajotrigu"] * 2


def test_repeated_words_elsewhere_dont_hide_a_passage():
    item = leaks.prepare({1: (ITEM, "238"), 2: (OTHER, "x")}, frozenset())[0]
    for table in ("Pajotrigu 3 " * 15, "3 30 17 " * 12):
        doc = tokens(AROUND + table + AROUND * 4 + QUESTION + " " + AROUND)
        places = {x: [j for j, y in enumerate(doc) if y == x] for x in doc}
        assert leaks.leaked(item, doc, places)


NAMELESS = "explique por que um contador que fecha o balanço antes do fim do exercício deve avisar o conselho e guardar as notas que ainda não foram pagas"


def test_items_without_names_or_numbers(spark):
    words = NAMELESS.split()
    texts = [AROUND + NAMELESS + ". " + AROUND, AROUND + NAMELESS.upper().replace("BALANÇO", "CAIXA"), AROUND + " ".join(words[:9]), AROUND + " ".join(reversed(words)), NAMELESS]
    texts += [AROUND + f"Contrato {i}." for i in range(60)]
    assert run(spark, texts, [(1, NAMELESS, None, "x"), (2, OTHER, "y", "x")]) == [(0, 1), (1, 1), (4, 1)]


def test_a_sentence_of_many_documents_is_a_formula(spark):
    texts = [AROUND + NAMELESS + f". Lote {i}." for i in range(40)] + [AROUND + f"Contrato {i}." for i in range(20)]
    assert run(spark, texts, [(1, NAMELESS, None, "x")]) == []


def test_numbers_of_a_plain_sentence_must_match():
    item = leaks.prepare({1: (NAMELESS + " no prazo de 45 dias", None)}, frozenset())[0]
    for days, want in (("45", 1), ("46", 0)):
        doc = tokens(AROUND + NAMELESS + f" no prazo de {days} dias " + AROUND)
        assert len(leaks.plain_matches(item, doc, {x: [j for j, y in enumerate(doc) if y == x] for x in doc})) == want


def test_the_answer_speaks_for_a_paraphrase():
    def found(text, answer):
        item = leaks.prepare({1: (ITEM, answer), 2: (OTHER, "x")}, frozenset())[0]
        doc = tokens(AROUND + text + " " + AROUND)
        return leaks.leaked(item, doc, {x: [j for j, y in enumerate(doc) if y == x] for x in doc})

    para = "Pajotrigu recebeu 51 empenhos, anulou 15 pois Brufubete achou R$ 386,78. Respondeu-se R$ 912,44."
    assert not found(para, "alternativa d") and found(para, "R$ 912,44") and not found(para, "R$ 912,45")
    assert not found("Respondeu-se R$ 912,44. " + AROUND, "R$ 912,44")
