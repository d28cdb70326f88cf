import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from erario.llm.tokens import TOKENIZERS, Automaton, Vocabulary, counts, decode, encode

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")


@pytest.fixture(scope="module")
def automaton():
    return Automaton(Vocabulary.read(PATH))


@pytest.fixture(scope="module")
def library():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def merged(raw, merges):
    """Merging by definition: the first merge that applies anywhere, at the leftmost place, until none does."""
    parts = [bytes([b]) for b in raw]
    while True:
        best = None
        for n, (a, b) in enumerate(merges):
            for i in range(len(parts) - 1):
                if parts[i] == a and parts[i + 1] == b:
                    best = (n, i)
                    break
            if best:
                break
        if not best:
            return parts
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), max_size=8), st.text("abc", max_size=12))
def test_automaton_is_merging_by_definition(picks, word):
    labels, number, merges = [b"a", b"b", b"c"], {b"a": 97, b"b": 98, b"c": 99}, []
    for i, j in picks:
        a, b = labels[i % len(labels)], labels[j % len(labels)]
        if (a, b) not in merges and a + b not in number:
            number[a + b] = 256 + len(merges)
            merges.append((a, b))
            labels.append(a + b)
    v = Vocabulary(list(range(256)), [(number[a], number[b]) for a, b in merges], [256 + i for i in range(len(merges))])
    a = Automaton(v)
    raw = word.encode()
    if raw:
        got = [a.by_id[t] for t in a.word(raw)]
        assert got == merged(raw, merges) or raw in a.token and got == [raw] and merged(raw, merges) == [raw]


def test_as_the_library_encodes(automaton, library):
    rng = random.Random(1)
    texts = ["Prestação de contas nº 12.345/2024 — R$ 1.234,56", "<|endoftext|> x", "  \n\t a", "don't we'll", "漢字😀é", "=" * 500, "a" * 700, "\x1c\x1d\x85​ "]
    texts += ["".join(rng.choice("abcdefghij éç0123456789.,'\n") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    for t in texts:
        assert automaton.encode(t) == library(t), t


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_round_trip(automaton, text):
    assert automaton.decode(automaton.encode(text)).decode() == text


def test_columns_nulls_and_clashes(spark):
    df = spark.createDataFrame([(1, "olá", "x"), (2, None, "x"), (3, "", "x"), (4, "  ", None), (1, "olá", "x")], "doc_id bigint, text string, ids string")
    got = encode(df, ["doc_id", "ids"]).collect()
    assert sorted((r["doc_id"], len(r["ids"])) for r in got)[0][0] == 1 and len(got) == 5
    by = {r["doc_id"]: r["ids"] for r in got}
    assert by[2] == [] and by[3] == [] and by[4]
    assert {r["doc_id"]: r["text"] for r in decode(encode(df, ["doc_id"]), ["doc_id"]).collect()} == {1: "olá", 2: "", 3: "", 4: "  "}
    assert encode(df.limit(0), ["doc_id"]).count() == 0
    c = {r["grupo"]: (r["documentos"], r["tokens"]) for r in counts(df, "ids").collect()}
    assert c["x"][0] == 4 and c[None][0] == 1


def test_very_long_and_broken_texts(spark):
    df = spark.sql("select 1 as doc_id, cast(x'ff41' as string) as text union all select 2, repeat('processo 123/2024 ', 50000)")
    got = {r["doc_id"]: r["ids"] for r in encode(df, ["doc_id"]).collect()}
    assert len(got[2]) > 100_000 and got[1]
