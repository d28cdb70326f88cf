import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from erario.llm.increments import History, Segment, alike, day_of, repeated, same_word, search, whole_number

ROWS = "linha_id bigint, carga_id bigint, id string, ano int, dataemissao string, codigoug string, codigocredor string, codprocesso string, valor double, historico string, lote string, __n string, chave string"
LOADS = "carga_id bigint, fonte string, data_extracao string, registros bigint, ordem string"
TEXT = "Aquisição de toner para impressora para o anexo da sede, processo 6831/2026, competência 06/2026, parcela 2/12"


def row(n, load=1, id="10", ano=2026, day="2026-06-18", ug="1", cr="2", pr="3/2026", v=10.0, h=TEXT):
    return (n, load, id, ano, day, ug, cr, pr, v, h, "x", "y", "z")


def found(spark, rows, loads=((1, "2026-01-01"), (2, "02/01/2026"), (3, "2026-01-03T00:00:00")), **kw):
    r = spark.createDataFrame(rows, ROWS)
    return sorted(x["linha_id"] for x in repeated(r, spark.createDataFrame([(c, "empenhos", d, None, "k") for c, d in loads], LOADS), **kw).collect())


def test_same_number_in_any_spelling(spark):
    rows = [row(1, id="4567"), row(2, 2, id="000004567"), row(3, 3, id="4.567"), row(4, 2, id="4567.0"), row(5, 2, id="4567", ano=2025), row(6, 2, id=" 4567 ", h=None)]
    for r in rows:
        assert r
    rows = [(*r[:5], str(i), *r[6:]) for i, r in enumerate(rows)]  # other bodies, so only the number counts
    assert found(spark, rows) == [2, 3, 4, 6]


def test_order_is_by_day_of_the_load(spark):
    rows = [row(1, 3, ug="a"), row(2, 1, ug="b"), row(3, 9, ug="c")]
    assert found(spark, rows) == [1, 3]  # load 9 isn't in the register: it comes last


def test_lost_and_reissued_numbers(spark):
    typed = "AQ. de tonre p/ impressora p/ o anexo da sede ; comp. 06/2026; proc. 6831/2026, parc. 2/12"
    rows = [
        row(1), row(2, 2, id="s/n", h=typed), row(3, 2, id="99", v=10.01, h=typed), row(4, 2, id="98", v=10.03, h=typed), row(5, 2, id="97", h=typed.replace("2/12", "3/12")),
        row(6, 2, id="96", cr=None), row(7, 2, id="95", pr=" "), row(8, 2, id="94", v=None), row(9, 2, id="93", day="2026-06-19"), row(10, 2, id="92", day="18/06/2026"),
        row(11, 2, id="91", h="Fornecimento contínuo de gêneros alimentícios, retificação, processo 6831/2026, competência 06/2026, parcela 2/12"), row(12, 2, id="90", h=None), row(13, 3, id="", h=None),
    ]
    assert found(spark, rows) == [2, 3, 10, 13]  # two rows without a description agree in it


def test_nulls_empty_tables_and_repeated_rows(spark):
    nothing = tuple([7, None] + [None] * 11)
    assert found(spark, [nothing, nothing, tuple([None] * 13), row(1), row(1)]) == []
    assert found(spark, []) == []
    assert found(spark, [row(1), row(2, 2)], loads=[]) == [2]


def test_a_hot_commitment(spark):
    rows = [row(i, 1 + i % 3, h=TEXT if i % 2 else TEXT.upper()) for i in range(600)] + [row(1000 + i, 1, id=str(i + 100), pr=f"x{i}/2026") for i in range(50)]
    assert len(found(spark, rows, shard_rows=50, batches=4)) == 599


def test_against_all_pairs(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = rng.choice(["Aquisição de toner", "Despesa com diárias", "Reforço para uniformes escolares"])
        rows.append(row(i, rng.randint(1, 3), id=rng.choice([None, "0", str(rng.randint(1, 400))]), ano=rng.choice([2025, 2026]), ug=str(rng.randint(1, 2)), cr=rng.choice(["5", "6", None]), pr=rng.choice(["7/25", "8/25"]), v=rng.choice([1.0, 1.01, 5.0]), h=f"{rng.choice([words, words.upper(), words.replace('ç', 'c')])}, parcela {rng.randint(1, 3)}/12"))
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    plain = lambda h: [w.replace("ç", "c").replace("ã", "a").replace("á", "a") for w in h.lower().replace(",", " ").replace("/", " ").split() if not w.isdigit()]
    want = []
    for j, b in enumerate(order):
        for a in order[:j]:
            ids = a[2] not in (None, "0") and a[2] == b[2] and a[3] == b[3]
            same = a[5:8] == b[5:8] and a[6] is not None and abs(a[8] - b[8]) <= 0.0100001 and a[9][-4:] == b[9][-4:] and alike(plain(a[9]), plain(b[9])) >= 0.58
            if ids or same:
                want.append(b[0])
                break
    assert found(spark, rows, shard_rows=60, batches=3) == sorted(want)


def segment(rng, n, first=0):
    words = ["aquisicao", "toner", "papel", "sede", "regional", "de", "para"]
    bodies = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 6))) for _ in range(n)]
    heads = [f"={rng.randint(1, 4)}|{rng.randint(1, 3)}|" for _ in range(n)]
    order = range(first, first + n)
    return Segment.of(heads, bodies, order, order, [1.0] * n, order), heads, bodies


def test_suffix_array_is_sorted_and_merges_like_one_made_at_once():
    rng = random.Random(3)
    a, ha, ba = segment(rng, 60)
    b, hb, bb = segment(rng, 45, 60)
    one = Segment.of(ha + hb, ba + bb, range(105), range(105), [1.0] * 105, range(105))
    both = a.merged(b)
    for s in (one, both):
        tails = [s.whole[i : s.ends[o]][:24] for i, o in zip(s.suffix, s.owner)]
        assert tails == sorted(tails)
        assert sorted(s.suffix.tolist()) == [i for i, c in enumerate(s.whole) if i in set(s.start.tolist()) or (c != 10 and s.whole[i - 1 : i] in (b" ", b"|") and i > s.start[np.searchsorted(s.start, i, "right") - 1] + 4)]
    assert both.whole == one.whole and sorted(both.suffix) == sorted(one.suffix)
    back = Segment.read(both.row(0))
    kept = back.part(np.arange(105) % 3 == 0)
    assert [kept.body(r) for r in range(35)] == [x.encode() for x in (ba + bb)[::3]]
    tails = [kept.whole[i : kept.ends[o]][:24] for i, o in zip(kept.suffix, kept.owner)]
    assert tails == sorted(tails)


def test_binary_search_and_coverage_against_all_records():
    rng = random.Random(5)
    s, heads, bodies = segment(rng, 80)
    for p in (b"=1|", b"=4|3|", b"=5"):
        lo, hi = s.beginning([p])
        assert hi[0] - lo[0] == sum(s.whole[i:].startswith(p) for i in s.start)
    for p in (b"toner", b"papel sede", b"zz"):
        lo, hi = s.holding(p)
        assert hi - lo == sum(s.whole[i:].startswith(p) for i in s.suffix)
    cover = s.coverage(b"aquisicao de toner para x", list(range(80)))
    for r, b in enumerate(bodies):
        whole = "aquisicao de toner para x".split()
        longest = {i for i in range(4) for k in range(i + 1, 5) if len(" ".join(whole[i:k])) + 1 >= 8 and f" {' '.join(whole[i:k])} " in f" {b} " for i in range(i, k)}
        assert cover[r] >= sum(len(whole[i]) for i in longest) and cover[r] <= sum(len(w) for w in whole if w in b.split())


def accepted(history, spark, rows, loads):
    return sorted(r["linha_id"] for r in history.accept(spark.createDataFrame(rows, ROWS), loads).collect())


def test_batches_are_held_against_segments_only(spark, tmp_path):
    rng = random.Random(8)
    loads = spark.createDataFrame([(c, "empenhos", f"2026-01-{c:02d}", None, "k") for c in range(1, 9)], LOADS)
    rows = [row(i, 1 + i // 30, id=rng.choice([None, str(rng.randint(1, 200))]), ug=str(rng.randint(1, 4)), v=rng.choice([10.23, 10.24, 10.25]), h=rng.choice([TEXT, TEXT.upper(), TEXT.replace("toner", "tonre"), "Despesa com diárias"])) for i in range(240)]
    history, got = History(spark, f"file://{tmp_path}/h", shard_rows=20), []
    for c in range(8):
        at = f"file://{tmp_path}/batch"
        spark.createDataFrame(rows[30 * c : 30 * c + 30], ROWS).write.mode("overwrite").parquet(at)  # the batch before is gone
        got += [r["linha_id"] for r in history.accept(spark.read.parquet(at), loads).collect()]
    whole = sorted(r["linha_id"] for r in repeated(spark.createDataFrame(rows, ROWS), loads, batches=1).collect())
    assert sorted(got) == whole
    segments = history.segments()
    assert len(segments) <= 5 and sum(s["rows"] for s in segments) <= 480
    assert max(s["rows"] for s in segments) > 100  # like sizes were merged
    again = accepted(history, spark, rows[210:], loads)
    assert again == sorted(x for x in got if x >= 210)


def test_leading_fields_of_many_texts_are_spread(spark, tmp_path):
    from itertools import product

    letters = "bcdfg"
    rows = [row(i, 1, id="", h=f"Compra {a * 9} {b * 9} {c * 9}, parcela 2/12") for i, (a, b, c) in enumerate(product(letters, repeat=3))]
    loads = spark.createDataFrame([(1, "e", "2026-01-01", 1, "k"), (2, "e", "2026-01-02", 1, "k")], LOADS)
    history = History(spark, f"file://{tmp_path}/h", shard_rows=20)
    first = accepted(history, spark, rows, loads)
    assert history.segments()[0]["hot"] and first == accepted(History(spark, f"file://{tmp_path}/one", 10**6), spark, rows, loads)
    later = [row(1000 + i, 2, id="", v=10.01, h=r[9].upper()) for i, r in enumerate(rows)]
    assert accepted(history, spark, later, loads) == [r[0] for r in later]


def test_an_earlier_record_only():
    s = Segment.of(["=1|10|", "#5|"], ["um dois", ""], [2, 2], [7, 8], [0.1, 0.0], [0, 0])
    ask = pd.DataFrame([("=1", 10, "um dois", 2, 7, 0.1), ("=1", 11, "dois um", 3, 1, 0.11), ("=1", 9, "um dois", 1, 9, 0.09), ("#5", 0, "", 2, 9, 0.0), ("#5", 0, "", 2, 8, 0.0)], columns=["cabeca", "centavos", "palavras", "ordem", "linha_id", "valor"])
    assert search(ask, s).tolist() == [False, True, False, True, False]


@pytest.mark.parametrize("a,b,want", [("toner", "tonre", True), ("pgto", "pagamento", True), ("p", "para", True), ("comp", "competencia", True), ("toner", "tinta", False), ("agua", "energia", False)])
def test_words(a, b, want):
    assert same_word(a, b) is want


def test_parsing(spark):
    df = spark.createDataFrame([("1.234", "2024-02-30"), ("12.34", "31/12/2024"), ("7.0", "2024-02-29T00:00:00.000-03:00"), ("abc", ""), (None, None), ("0000", "x")], "a string, b string")
    got = df.select(whole_number(F.col("a")).alias("n"), day_of(F.col("b")).cast("string").alias("d")).collect()
    assert [(r["n"], r["d"]) for r in got] == [(1234, None), (None, "2024-12-31"), (7, "2024-02-29"), (None, None), (None, None), (None, None)]
