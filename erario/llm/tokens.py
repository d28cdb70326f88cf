"""Encoding of a corpus with a byte-level BPE vocabulary, by a tokenization automaton.

The automaton reads tokens. It starts as one state that loops on every byte, so that it accepts every byte sequence.
Each merge (a, b) -> w, taken in order, adds a gadget: a state for w, left by what b may be followed by at that time; an
arc w beside every path a, b; and the removal of arc b from the state after a. What remains after the last merge are
exactly the sequences that merging byte by byte would give, and since such a sequence is right if and only if each two
neighbours are, the state after a token depends on that token only.

Written out, the table has (number of tokens)² arcs. It is therefore filled on first use: ``arc`` finds whether an arc
is left after all gadgets by going back from the gadget that made it, and keeps the answer. Words are encoded by one
walk over their bytes: the last token of each prefix is the one vocabulary entry that ends there and has an arc from
the state before it. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value of the vocabulary: how text is split before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where the vocabulary files are, unless another path is given.
TOKENIZERS = "/opt/tokenizers"
#: Words and arcs that a worker keeps before it starts over; only memory depends on it, not the result.
KEPT_WORDS, KEPT_ARCS = 200_000, 2_000_000
#: Words of more bytes than this aren't kept.
KEPT_BYTES = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabulary files: printable Latin-1 as it is, the rest moved up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(moved)) for b in range(256)]


class Vocabulary:
    """Merges in order and the id of every token: what an automaton is compiled from."""

    def __init__(self, byte_ids: list[int], merges: list[tuple[int, int]], merge_ids: list[int]):
        self.byte_ids, self.merges, self.merge_ids = byte_ids, merges, merge_ids

    @classmethod
    def read(cls, path: str | Path) -> Vocabulary:
        """From a byte-level BPE file in JSON. Tokens count as bytes 0 to 255, then the merges in order."""
        model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
        letters = byte_letters()
        vocab = model["vocab"]
        number = {x: i for i, x in enumerate(letters)}
        merges, ids = [], []
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merges.append((number[a], number[b]))
            number.setdefault(a + b, 256 + len(ids))
            ids.append(vocab[a + b])
        return cls([vocab[x] for x in letters], merges, ids)


class Automaton:
    """Deterministic automaton over the tokens of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.ids = [*vocabulary.byte_ids, *vocabulary.merge_ids]
        self.left, self.right = [*range(256)], [*range(256)]
        self.label: list[bytes] = [bytes([b]) for b in range(256)]
        self.gadget: dict[tuple[int, int], int] = {}
        self.arcs: dict[tuple[int, int], bool] = {}
        self.token: dict[bytes, int] = {x: i for i, x in enumerate(self.label)}
        live = [True] * 256
        for a, b in vocabulary.merges:  # successive gadgets
            w = len(self.label)
            ok = live[a] and live[b] and (a, b) not in self.gadget and self._left_over(a, b, w - 1)
            self.left.append(a)
            self.right.append(b)
            self.label.append(self.label[a] + self.label[b])
            live.append(ok)
            if ok:  # else no path a, b is left that the gadget could merge
                self.gadget[a, b] = w
                self.token.setdefault(self.label[w], w)
        self.longest = max(map(len, self.token))
        self.by_id = {i: x for i, x in zip(self.ids, self.label)}
        self.words: dict[str, tuple[int, ...]] = {}
        self.split = regex.compile(PATTERN).findall

    def _left_over(self, u: int, v: int, t: int) -> bool:
        """Whether the state after u has an arc v once the gadgets up to t are in, both tokens being there by then."""
        gadget, left, right = self.gadget, self.left, self.right
        while True:
            w = gadget.get((u, v))
            if w is not None and w <= t:
                return False  # removed by its own merge
            if u < 256 and v < 256:
                return True
            if u > v:  # the state came later: a copy of the one after its right part
                t, u = u - 1, right[u]
            elif u < v:  # the arc came later: beside the path of its parts
                if u == left[v] == right[v]:
                    return False  # of three alike the first two merge
                t, v = v - 1, left[v]
            else:
                t, u, v = u - 1, right[u], left[u]

    def arc(self, u: int, v: int) -> bool:
        """Whether token v may follow token u."""
        got = self.arcs.get((u, v))
        if got is None:
            if len(self.arcs) >= KEPT_ARCS:
                self.arcs.clear()
            got = self.arcs[u, v] = self._left_over(u, v, len(self.label))
        return got

    def word(self, raw: bytes) -> tuple[int, ...]:
        """Ids of one word. The walk holds the state after each prefix."""
        token, arc, longest = self.token, self.arc, self.longest
        whole = token.get(raw)
        if whole is not None:
            return (self.ids[whole],)
        state: list[int] = [-1]
        for end in range(1, len(raw) + 1):
            for start in range(max(0, end - longest), end):
                t = token.get(raw[start:end])
                if t is not None and (start == 0 or arc(state[start], t)):
                    state.append(t)
                    break
        out, end = [], len(raw)
        while end:
            out.append(self.ids[state[end]])
            end -= len(self.label[state[end]])
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        """Ids of a text; special tokens in it are ordinary text."""
        out: list[int] = []
        words = self.words
        for w in self.split(text):
            ids = words.get(w)
            if ids is None:
                ids = self.word(raw := w.encode("utf-8", "surrogatepass"))
                if len(raw) <= KEPT_BYTES:
                    if len(words) >= KEPT_WORDS:
                        words.clear()
                    words[w] = ids
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        """The labels of the arcs, one after the other; an id that isn't in the vocabulary has none."""
        return b"".join(self.by_id.get(i, b"") for i in ids)


_compiled: dict[int, Automaton] = {}


def _automaton(shared) -> Automaton:
    """Of a broadcast vocabulary, compiled once in each worker process."""
    if shared.value.key not in _compiled:
        _compiled.clear()
        _compiled[shared.value.key] = Automaton(shared.value)
    return _compiled[shared.value.key]


def _shared(df: DataFrame, name: str, tokenizers: str):
    v = Vocabulary.read(Path(tokenizers) / f"{name}.json")
    v.key = hash((name, tokenizers, len(v.merges)))  # type: ignore[attr-defined]
    return df.sparkSession.sparkContext.broadcast(v)  # of fixed size: the vocabulary


def encode(df: DataFrame, keep: list[str], text: str = "text", name: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(*keep, ids): the token ids of each row's whole text, without special tokens.

    Null and empty texts give an empty list; blank ones are encoded. Bytes that aren't UTF-8 are read as U+FFFD. Every
    row gives one row, repeated rows and empty tables included. A column of ``keep`` that is called ids gives way.
    """
    shared = _shared(df, name, tokenizers)
    keep = [c for c in keep if c != "ids"]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _automaton(shared)
        for batch in batches:
            sizes, flat = np.zeros(batch.num_rows + 1, "int32"), []
            for i, raw in enumerate(batch.column("__text")):
                raw = raw.as_py()
                if raw:
                    ids = a.encode(raw.decode("utf-8", "replace"))
                    sizes[i + 1] = len(ids)
                    flat.append(np.array(ids, dtype="int32"))
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, "int32"), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype="int32"), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], ids], names=[*keep, "ids"])

    return df.select(*keep, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)


def decode(df: DataFrame, keep: list[str], ids: str = "ids", name: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(*keep, text): the text that the ids of each row stand for; null and empty lists give an empty text."""
    shared = _shared(df, name, tokenizers)
    keep = [c for c in keep if c != "text"]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("text", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _automaton(shared)
        for batch in batches:
            texts = [a.decode(x.as_py() or []).decode("utf-8", "replace") for x in batch.column("__ids")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"])

    return df.select(*keep, F.col(ids).alias("__ids")).mapInArrow(run, schema)


def counts(df: DataFrame, by: Column | str, text: str = "text", name: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(grupo, documentos, tokens, distintos): size of the encoded corpus by group, null a group of its own."""
    e = encode(df.withColumn("grupo", F.col(by) if isinstance(by, str) else by), ["grupo"], text, name, tokenizers)
    sizes = e.groupBy("grupo").agg(F.count("*").alias("documentos"), F.sum(F.size("ids")).cast("bigint").alias("tokens"))
    kinds = e.select("grupo", F.explode("ids").alias("id")).groupBy("grupo", "id").count().groupBy("grupo").agg(F.count("*").alias("distintos"))
    return sizes.join(kinds.withColumnRenamed("grupo", "__g"), sizes["grupo"].eqNullSafe(F.col("__g")), "left").select("grupo", "documentos", "tokens", F.coalesce("distintos", F.lit(0)).alias("distintos"))
