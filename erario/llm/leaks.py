"""Evaluation texts inside a training corpus, found by latent semantic retrieval and checked word by word.

1. Every text becomes numbers of words, once; it is cut into passages, which are TF-IDF vectors over hashed words.
2. A distributed randomised SVD of the passages of corpus and items gives a latent space: two passes of the form
   sum over partitions of A'(A X), with X random at first and an orthonormal basis of the first result then. Only
   matrices of fixed size (hash width x rank) are gathered.
3. Every passage is projected and compared with all item passages by cosine, in blocks.
4. Items that are near enough are aligned with the document by longest common subsequences of their sentences; the
   item's own words (names, numbers) decide between the item and a text of the same build. A paraphrase that keeps fewer
   of its words counts if the item's answer stands beside them.
5. Of an item with hardly an own word, sentences must stand there nearly whole, and not in so many documents that they
   are formulas.

The items are the stated query set; they and the latent basis are broadcast, both of fixed size.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erario.llm.text import plain, tokens
from erario.session import written

#: Hashed words, latent dimensions, words of a passage and the step between the starts of passages.
WIDTH, RANK, PASSAGE, STEP = 1 << 14, 64, 32, 16
#: Least cosine of a corpus passage to an item passage for the item to be aligned.
COSINE = 0.5
#: Rows of the matrix that travel as one block, and tasks among which the parts of a block are added up at first.
BLOCK, SPREAD = 1024, 64
#: Words of an item that must stand in the document, and the share of the item's own words among those it should hold.
LEAST_WORDS, LEAST_OWN, OWN_SHARE = 12, 3, 0.5
#: Words of an item that do if its answer stands beside them, and how near (words) that is.
ANSWERED_WORDS, BESIDE = 9, 96
#: Words that must match of sentences with hardly an own word, and the share of such a sentence.
PLAIN_WORDS, PLAIN_SHARE = 15, 0.8
#: Items that one search takes at most: they are held in memory, with the vectors of their passages.
MOST_ITEMS = 20_000
#: Share of the passages from which a word is nobody's name, and of the documents from which a sentence is a formula.
OFTEN = float(np.exp(-6.0))


class Numbers(dict):
    """A 64-bit number for each word, kept for the words met lately."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        n = self[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big", signed=True)
        return n


def hashed(words: Iterable[str], memo: Numbers) -> list[int]:
    """The number of each word."""
    return list(map(memo.__getitem__, words))


def buckets(ids: np.ndarray) -> np.ndarray:
    """Column of each word's number in the passage vectors."""
    return (ids & (WIDTH - 1)).astype("int64")


def passages(ids: np.ndarray, step: int = STEP) -> list[np.ndarray]:
    """Overlapping runs of PASSAGE words; the last may be shorter, a short text is one passage."""
    last = max(1, -(-max(0, len(ids) - PASSAGE) // step) + 1)
    return [ids[i * step : i * step + PASSAGE] for i in range(last)] if len(ids) else []


@dataclass
class Sparse:
    """Rows of weighted hashed words."""

    row: np.ndarray
    word: np.ndarray
    weight: np.ndarray
    rows: int

    def times(self, x: np.ndarray) -> np.ndarray:
        """A X."""
        out = np.zeros((self.rows, x.shape[1]), "float32")
        start = np.flatnonzero(np.r_[True, self.row[1:] != self.row[:-1]]) if len(self.row) else np.zeros(0, int)
        if len(start):
            out[self.row[start]] = np.add.reduceat(x[self.word] * self.weight[:, None], start, axis=0)
        return out

    def back(self, y: np.ndarray, out: np.ndarray) -> None:
        """Add A' Y to ``out``."""
        if len(self.row):
            order = np.argsort(self.word, kind="stable")
            w = self.word[order]
            start = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            out[w[start]] += np.add.reduceat(y[self.row[order]] * self.weight[order][:, None], start, axis=0)


def weighted(parts: list[np.ndarray], idf: np.ndarray) -> Sparse:
    """Normalised TF-IDF rows (sublinear tf) of passages."""
    if not parts:
        return Sparse(np.zeros(0, int), np.zeros(0, int), np.zeros(0, "float32"), 0)
    sizes = np.fromiter(map(len, parts), int, len(parts))
    keys, n = np.unique(np.repeat(np.arange(len(parts)), sizes) * WIDTH + buckets(np.concatenate(parts)), return_counts=True)
    row, word = keys // WIDTH, keys % WIDTH
    w = (1 + np.log(n)) * idf[word]
    norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(parts)))
    return Sparse(row, word, (w / np.maximum(norm[row], 1e-9)).astype("float32"), len(parts))


def _texts(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    col = batch.column(name)
    values, offsets = col.flatten().to_numpy(), col.offsets.to_numpy()
    offsets = offsets - offsets[0]
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _summed(df: DataFrame, make) -> np.ndarray:
    """Sum over the partitions of a matrix of WIDTH rows, gathered in blocks of fixed number and size.

    The parts of a block are added up in SPREAD tasks first, then in one, batch by batch: no task holds more than the
    blocks that it adds to, and none reads all parts of a block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = make(batches)
        if m is not None:
            m = m.astype("float32")
            spread = TaskContext.get().partitionId() % SPREAD
            for b in range(0, WIDTH, BLOCK):
                yield pa.RecordBatch.from_pydict({"block": pa.array([b // BLOCK], pa.int32()), "spread": pa.array([spread], pa.int32()), "part": pa.array([m[b : b + BLOCK].tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist()):
                x = np.frombuffer(part, "float32")
                total[block] = total[block] + x if block in total else x.astype("float64")
        for block, x in total.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "spread": pa.array([0], pa.int32()), "part": pa.array([x.astype("float32").tobytes()], pa.binary())})

    schema = "block int, spread int, part binary"
    parts = df.mapInArrow(run, schema).repartition("block", "spread").mapInArrow(add, schema)
    got = parts.repartition("block").mapInArrow(add, schema).collect()
    if not got:
        return np.zeros((WIDTH, 0))
    return np.concatenate([np.frombuffer(r["part"], "float32").reshape(BLOCK, -1).astype("float64") for r in sorted(got, key=lambda r: r["block"])])


def latent_space(words: DataFrame, items: list[np.ndarray], rank: int = RANK, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(idf, basis, singular values) of the passages of ``words`` (column ids: hashed words) and of the items.

    The basis has WIDTH rows and ``rank`` orthonormal columns: the leading right singular vectors.
    """
    session = words.sparkSession

    def frequency(batches):
        n = np.zeros((WIDTH, 2))
        for batch in batches:
            for ids in _texts(batch, "ids"):
                for p in passages(buckets(ids), PASSAGE):
                    n[np.unique(p), 0] += 1
                    n[0, 1] += 1
        return n

    counts = _summed(words, frequency)
    own = [p for ids in items for p in passages(ids, STEP)]
    n = (counts[0, 1] if counts.size else 0) + len(own)
    df = (counts[:, 0] if counts.size else np.zeros(WIDTH)).copy()
    for p in own:
        df[np.unique(buckets(p))] += 1
    idf = np.log((1 + n) / (1 + df)).astype("float32")
    wide = rank + 8
    x = np.random.default_rng(seed).standard_normal((WIDTH, wide)).astype("float32")
    mine = weighted(own, idf)
    for last in (False, True):
        shared = session.sparkContext.broadcast((idf, x))  # fixed size

        def power(batches, shared=shared):
            idf, x = shared.value
            out = np.zeros((WIDTH, x.shape[1]), "float32")
            for batch in batches:
                texts = _texts(batch, "ids")
                for lo in range(0, len(texts), 500):
                    a = weighted([p for ids in texts[lo : lo + 500] for p in passages(ids, PASSAGE)], idf)
                    a.back(a.times(x), out)
            return out

        y = _summed(words, power)
        y = y if y.size else np.zeros((WIDTH, wide))
        z = np.zeros((WIDTH, wide), "float32")
        mine.back(mine.times(x), z)
        y = y + z
        if last:
            small = x.T.astype("float64") @ y
            value, vector = np.linalg.eigh((small + small.T) / 2)
            top = np.argsort(-value)[:rank]
            return idf, (x @ vector[:, top]).astype("float32"), np.sqrt(np.maximum(value[top], 0))
        x = np.linalg.qr(y)[0].astype("float32")
    raise AssertionError


@dataclass
class Item:
    """An evaluation item ready for alignment."""

    item_id: int
    sentences: list[list[str]]
    word_of: list[list[int]]  # number of the written word that each token belongs to
    own: frozenset[str]
    names: frozenset[str]
    answer: frozenset[str] = frozenset()  # names and numbers of the answer that the question doesn't hold

    def plain_sentences(self) -> list[int]:
        """Numbers of the sentences of an item with so few own words that these can't decide; none of other items."""
        return [] if self.names or len(self.own) >= 2 * LEAST_OWN else list(range(len(self.sentences)))

    def numbered(self) -> Item:
        """The same with the numbers of words in their place."""
        f = lambda ws: hashed(ws, Numbers())
        return replace(self, sentences=[f(s) for s in self.sentences], own=frozenset(f(self.own)), names=frozenset(f(self.names)), answer=frozenset(f(self.answer)))


_WORD = re.compile(r"\S+")
_PARTS = re.compile(r"(?<=[.!?])\s+|\s+(?=\([a-z]\)\s)")


def possible_names(texts: dict[int, tuple[str, str]]) -> dict[int, frozenset[str]]:
    """Words of each item that may be names: longer ones that it writes with a capital everywhere and few items hold."""
    held = {k: set(tokens(q)) for k, (q, _) in texts.items()}
    uses = Counter(w for ws in held.values() for w in ws)
    out = {}
    for k, (q, _) in texts.items():
        # names are written with a capital wherever they stand; a text in one case only can't tell
        low = {x for w in _WORD.findall(q) if w[:1].islower() for x in tokens(w)}
        out[k] = frozenset(x for x in held[k] if not x.isdigit() and x not in low and len(x) > 4 and uses[x] <= max(2, 0.03 * len(texts)))
    return out


class Away:
    """Passages of a text in which possible names of the items stand away from the item's other own words.

    An occurrence with LEAST_OWN other possible names or numbers of the item near it belongs to a copy of the item and
    tells nothing of how common the word is.
    """

    def __init__(self, texts: dict[int, tuple[str, str]]):
        names = possible_names(texts)
        self.own = {k: names[k] | {x for x in tokens(q) if x.isdigit()} for k, (q, _) in texts.items()}
        self.items: dict[str, list[int]] = defaultdict(list)
        for k, ws in names.items():
            for w in ws:
                self.items[w].append(k)
        self.words = sorted(self.items)
        self.number = {w: i for i, w in enumerate(self.words)}

    def numbered(self) -> Away:
        """The same with the numbers of words in their place."""
        out = object.__new__(Away)
        f = lambda ws: hashed(ws, Numbers())
        out.own = {k: set(f(ws)) for k, ws in self.own.items()}
        out.words = f(self.words)
        out.items = {h: self.items[w] for h, w in zip(out.words, self.words)}
        out.number = {h: i for i, h in enumerate(out.words)}
        return out

    def of(self, toks: list) -> list[int]:
        """Numbers in ``words``, one for each passage (of PASSAGE words, without overlap) and word."""
        out = set()
        for j, w in enumerate(toks):
            i = self.number.get(w)
            if i is not None and (j // PASSAGE, i) not in out:
                near = set(toks[max(0, j - PASSAGE) : j + PASSAGE + 1]) - {w}
                if all(len(near & self.own[k]) < LEAST_OWN for k in self.items[w]):
                    out.add((j // PASSAGE, i))
        return [i for _, i in out]


def prepare(texts: dict[int, tuple[str, str]], common: frozenset[str]) -> list[Item]:
    """Items with their own words: names and numbers that no stock formula holds.

    texts: item_id -> (text, answer). common: those of the possible names that many corpus texts hold. Sentences all of
    whose words are common or that several items share word by word are formulas and don't count.
    """
    possible = possible_names(texts)
    plains = {k: plain(q) for k, (q, _) in texts.items()}
    shared = Counter(s for q in plains.values() for s in {" ".join(tokens(x)) for x in _PARTS.split(q)})
    out = []
    for k in texts:
        sents, of = [], []
        for s in _PARTS.split(plains[k]):
            t, num = [], []
            for i, w in enumerate(_WORD.findall(s)):
                for x in tokens(w):
                    t.append(x)
                    num.append(i)
            if t and shared[" ".join(t)] == 1 and any(x.isdigit() or x not in common for x in t):
                sents.append(t)
                of.append(num)
        used = {x for t in sents for x in t}
        names = used & possible[k] - common
        own = names | {x for x in used if x.isdigit()}
        # an answer of common words only, such as the letter of a choice, tells nothing
        answer = {x for w in _WORD.findall(texts[k][1] or "") for x in tokens(w) if x.isdigit() or (w[:1].isupper() and len(x) > 4 and x not in common)} - set(tokens(texts[k][0]))
        out.append(Item(k, sents, of, frozenset(own), frozenset(names), frozenset(answer)))
    return out


def common_words(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence of two token lists as pairs of places."""
    where = defaultdict(list)
    for j, x in enumerate(b):
        where[x].append(j)
    # patience over the matches in order of a, later places of b first: longest increasing run of places
    tails: list[int] = []
    last: list[int] = []
    links: list[tuple[int, int, int]] = []
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            lo, hi = 0, len(tails)
            while lo < hi:
                mid = (lo + hi) // 2
                if tails[mid] < j:
                    lo = mid + 1
                else:
                    hi = mid
            links.append((i, j, last[lo - 1] if lo else -1))
            if lo == len(tails):
                tails.append(j)
                last.append(len(links) - 1)
            else:
                tails[lo], last[lo] = j, len(links) - 1
    out, at = [], last[-1] if last else -1
    while at >= 0:
        i, j, at = links[at]
        out.append((i, j))
    return out[::-1]


def stretches(own_at: list[tuple[int, str]], reach: int) -> list[tuple[int, int]]:
    """(distinct words, first place) of the longest stretches within reach, most distinct words first."""
    out, lo, inside = [], 0, Counter()
    for hi, (j, x) in enumerate(own_at):
        while j - own_at[lo][0] > reach:
            gone = own_at[lo][1]
            inside[gone] -= 1
            if not inside[gone]:
                del inside[gone]
            lo += 1
        inside[x] += 1
        if hi + 1 == len(own_at) or own_at[hi + 1][0] - own_at[lo][0] > reach:
            out.append((len(inside), own_at[lo][0]))
    return sorted(out, key=lambda x: (-x[0], x[1]))


def evidence(item: Item, doc: list[str], places: dict[str, list[int]]) -> tuple[int, int, int]:
    """(words of the item in the document, own words matched, own words within the matched parts).

    Of the stretches of the document that hold own words of a sentence, the one counts that matches most of them.
    """
    words = hit = due = 0
    for s, num in zip(item.sentences, item.word_of):
        own = set(s) & item.own
        own_at = sorted((j, x) for x in own for j in places.get(x, ()))
        best = (0, 0, 0)
        for _, first in stretches(own_at, len(s) + 6):
            window = doc[max(0, first - len(s)) : first + len(s) + 8]
            held = own.intersection(window)
            # no more own words match than the window holds; without a name it takes three
            if (most := sum(x in held for x in s)) < best[0] or most < 3 and not held & item.names:
                continue
            pairs = common_words(s, window)
            # the densest run: the match may not stretch over far more of the document than of the item
            while pairs and pairs[-1][1] - pairs[0][1] > 1.6 * (pairs[-1][0] - pairs[0][0]) + 8:
                gap_first = pairs[1][1] - pairs[0][1] if len(pairs) > 1 else 0
                gap_last = pairs[-1][1] - pairs[-2][1] if len(pairs) > 1 else 0
                pairs = pairs[1:] if gap_first >= gap_last else pairs[:-1]
            if not pairs:
                continue
            got = {s[i] for i, _ in pairs}
            own_in = [i for i in range(pairs[0][0], pairs[-1][0] + 1) if s[i] in item.own]
            matched = {i for i, _ in pairs}
            ok = sum(i in matched for i in own_in)
            if own_in and ok >= 0.34 * len(own_in) and (got & item.names or ok >= 3):
                best = max(best, (ok, len({num[i] for i in matched}), -len(own_in)))
        hit, words, due = hit + best[0], words + best[1], due - best[2]
    return words, hit, due


def beside(item: Item, places: dict[str, list[int]]) -> bool:
    """Whether the whole answer stands in the document, with own words of the item near it."""
    if not item.answer or any(x not in places for x in item.answer):
        return False
    first, *rest = sorted(item.answer, key=lambda x: len(places[x]))
    own = [places[x] for x in item.own if x in places]
    for p in places[first]:
        if all(any(abs(q - p) <= 8 for q in places[x]) for x in rest) and sum(any(abs(q - p) <= BESIDE for q in qs) for qs in own) >= LEAST_OWN:
            return True
    return False


def leaked(item: Item, doc: list[str], places: dict[str, list[int]]) -> bool:
    """Whether the document holds the item or a good part of it, as far as its own words tell."""
    words, hit, due = evidence(item, doc, places)
    enough = hit >= LEAST_OWN and hit >= OWN_SHARE * due
    return enough and (words >= LEAST_WORDS or words >= ANSWERED_WORDS and beside(item, places))


def plain_matches(item: Item, doc: list[str], places: dict[str, list[int]]) -> list[tuple[int, int]]:
    """(sentence, words matched) of the sentences, of an item with hardly an own word, that stand in the document nearly whole.

    A sentence's numbers must all match; of its other words PLAIN_SHARE, in order and close together.
    """
    out = []
    for n in item.plain_sentences():
        s, num = item.sentences[n], item.word_of[n]
        held = set(s)
        if sum(x in places for x in held) < PLAIN_SHARE * len(held) or any(x not in places for x in held & item.own):
            continue
        best = 0
        # every stretch that holds enough different words of the sentence
        at = sorted((j, x) for x in held for j in places.get(x, ()))
        for distinct, first in stretches(at, int(1.25 * len(s)) + 2):
            if distinct < PLAIN_SHARE * len(held):
                break
            pairs = common_words(s, doc[first : first + int(1.25 * len(s)) + 3])
            got = {i for i, _ in pairs}
            if len(pairs) >= PLAIN_SHARE * len(s) and all(i in got for i, x in enumerate(s) if x in item.own):
                best = max(best, len({num[i] for i in got}))
        if best:
            out.append((n, best))
    return out


def find(documents: DataFrame, items: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(doc_id, item_id): documents that hold an item's text or a good part of it, each pair once.

    Blank and null texts hold nothing; without items the result is empty. Whole texts are read, in overlapping passages.
    Texts changed in typography, order of sentences or a few words are found; stock formulas, opening words and texts of
    the same build with other names and numbers are not. Of an item
    without names and with few numbers a sentence counts that stands there nearly whole, unless it does in more than OFTEN
    of the documents, which makes it a formula. Items are a stated query set that the driver holds;
    more than MOST_ITEMS of them are an error.
    """
    session = documents.sparkSession
    schema = T.StructType([documents.schema["doc_id"], items.schema["item_id"]])
    asked = {r["item_id"]: (r["enunciado"] or "", r["resposta"] or "") for r in items.select("item_id", "enunciado", "resposta").limit(MOST_ITEMS + 1).collect()}  # the query set
    if len(asked) > MOST_ITEMS:
        raise ValueError(f"more than {MOST_ITEMS} items; search them in parts")
    asked = {k: x for k, x in asked.items() if k is not None and x[0].strip()}
    if not asked:
        return session.createDataFrame([], schema)
    texts = documents.filter("text is not null and trim(text) <> ''").select("doc_id", "text")

    named = Away(asked)
    away = named.numbered()
    id_type, item_type = _arrow(documents.schema["doc_id"].dataType), _arrow(items.schema["item_id"].dataType)

    def to_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Numbers()
        for batch in batches:
            toks = [hashed(tokens(x), memo) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(id_type), pa.array(toks, pa.list_(pa.int64())), pa.array([away.of(t) for t in toks], pa.list_(pa.int32()))], names=["doc_id", "ids", "away"])

    words_schema = T.StructType([documents.schema["doc_id"], T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("away", T.ArrayType(T.IntegerType()))])
    read = written(texts.mapInArrow(to_words, words_schema), "leak-words")
    words = read.select("ids")
    memo = Numbers()
    item_words = {k: np.array(hashed(tokens(q), memo), dtype="int64") for k, (q, _) in asked.items()}
    idf, basis, _ = latent_space(words, list(item_words.values()))

    query, owner = [], []
    for n, (_, ids) in enumerate(item_words.items()):
        for p in passages(ids, STEP // 2):
            query.append(p)
            owner.append(n)
    q = weighted(query, idf).times(basis)
    q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-9)
    # words that are no item's own: those that occur in many passages of the corpus away from the item's other words
    size = words.filter("size(ids) > 0").agg(F.sum(F.ceil(F.size("ids") / PASSAGE)).alias("n"), F.count("*").alias("docs")).first()
    n, docs = size["n"] or 0, size["docs"]
    times = read.select(F.explode("away").alias("w")).groupBy("w").count().collect()  # at most the items' words
    common = frozenset(named.words[r["w"]] for r in times if r["count"] > max(OFTEN * n, 30))
    shared = session.sparkContext.broadcast((idf, basis, q, np.array(owner), [x.numbered() for x in prepare(asked, common)]))  # bounded by MOST_ITEMS

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis, q, owner, items = shared.value
        plain_items = {k for k, x in enumerate(items) if x.plain_sentences()}
        need = [max(6, min(PLAIN_WORDS, sum(len(set(x)) for x in item.word_of))) for item in items]
        for batch in batches:
            ids = batch.column("doc_id")
            all_words = _texts(batch, "ids")
            for lo in range(0, len(all_words), 200):
                toks = all_words[lo : lo + 200]
                parts, of = [], []
                for d, t in enumerate(toks):
                    for p in passages(t):
                        parts.append(p)
                        of.append(d)
                if not parts:
                    continue
                v = weighted(parts, idf).times(basis)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
                near: dict[int, set[int]] = defaultdict(set)
                for b in range(0, len(v), 2000):
                    i, j = np.nonzero(v[b : b + 2000] @ q.T >= cosine)
                    for d, k in set(zip(np.array(of)[b + i].tolist(), owner[j].tolist())):
                        near[d].add(k)
                at, found, sentence, matched = [], [], [], []
                for d, ks in sorted(near.items()):
                    doc = toks[d].tolist()
                    held = set(doc)
                    enough = {k for k in ks if len(items[k].own & held) >= (2 * LEAST_OWN if items[k].names.isdisjoint(held) else LEAST_OWN)}
                    if not enough and plain_items.isdisjoint(ks):
                        continue
                    places: dict[int, list[int]] = defaultdict(list)
                    for j, x in enumerate(doc):
                        places[x].append(j)
                    for k in sorted(enough | (ks & plain_items)):
                        item = items[k]
                        got: list[tuple[int, int]] = []
                        if k in enough and leaked(item, doc, places):
                            got = [(-1, 0)]
                        elif k in plain_items:
                            got = plain_matches(item, doc, places)
                        for s, m in got:
                            at.append(lo + d)
                            found.append(k)
                            sentence.append(s)
                            matched.append(m)
                if at:
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array([items[k].item_id for k in found], item_type), *[pa.array(x, pa.int32()) for x in (sentence, matched, [need[k] for k in found])]], names=["doc_id", "item_id", "frase", "palavras", "bastam"])

    found = T.StructType([documents.schema["doc_id"], items.schema["item_id"], *[T.StructField(c, T.IntegerType()) for c in ("frase", "palavras", "bastam")]])
    hits = written(read.select("doc_id", "ids").mapInArrow(search, found), "leak-hits")
    plain_hits = hits.filter("frase >= 0")
    often = plain_hits.groupBy("item_id", "frase").agg(F.countDistinct("doc_id").alias("__n")).filter(F.col("__n") > F.lit(max(OFTEN * docs, 30)))
    kept = plain_hits.join(often, ["item_id", "frase"], "left_anti").groupBy("doc_id", "item_id").agg(F.sum("palavras").alias("__m"), F.first("bastam").alias("__need"))
    return hits.filter("frase < 0").select("doc_id", "item_id").unionByName(kept.filter("__m >= __need").select("doc_id", "item_id")).distinct()


def _arrow(t: T.DataType) -> pa.DataType:
    return pa.int64() if t.typeName() == "long" else pa.string() if t.typeName() == "string" else pa.int32()
