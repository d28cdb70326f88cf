"""Subject areas of documents: bisecting k-means over normalised vectors, leaves labelled by discriminative terms.

The unit that is clustered is the sentence, as a document may have several areas of which each fills a few sentences.
Terms (words and pairs of neighbours) are weighted by how well they discriminate the labelled areas, so the frames that
sentences of all areas share carry no weight. The tree of clusters and the share of each area in each leaf are learnt
from a bounded sample of labelled documents; every sentence of every document then goes down the tree, and a document
gets each area that the mixture of the leaf of at least one sentence holds a good share of.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erario.llm.text import plain, sentences

#: Labelled documents that the tree is learnt from, at most (chosen by a hash of their id).
SAMPLE_DOCS = 8_000
#: Leaves of the tree at most, sentences in a leaf at least, and the mean cosine at which a cluster isn't split further.
LEAVES, LEAST, TIGHT = 1200, 6, 0.96
#: Share of a leaf's mixture from which its sentences have an area.
SHARE = 0.8
#: Least length of a sentence's weighted vector, and least cosine to its leaf; below, a sentence has no subject.
LEAST_NORM, LEAST_COSINE = 0.8, 0.3
#: Sentences in which a term of the vocabulary occurs, at least, and its least weight.
TERM_COUNT, TERM_WEIGHT = 4, 0.6

_WORD = re.compile(r"[a-z]{2,}")


def terms(sentence: str) -> list[str]:
    """Words of two letters or more, and pairs of neighbours among those of three or more."""
    w = _WORD.findall(sentence)
    long = [x for x in w if len(x) > 2]
    return [*w, *map(" ".join, zip(long, long[1:]))]


@dataclass
class Tree:
    """Vocabulary, nodes of the bisection (children, centroids) and the mixture of areas in each leaf."""

    vocabulary: dict[str, int]
    weight: np.ndarray
    children: np.ndarray  # (nodes, 2), -1 at leaves
    centroid: np.ndarray  # (nodes, terms)
    mixture: np.ndarray  # (nodes, areas): what its sentences are about, as far as labels and terms tell; the rest to 1 is no area
    areas: list[str]

    def leaf_terms(self, node: int, n: int = 5) -> list[str]:
        """The terms that tell a leaf from the others: the heaviest ones of its centroid."""
        names = list(self.vocabulary)
        return [names[i] for i in np.argsort(-self.centroid[node])[:n] if self.centroid[node][i] > 0]


def _rows(bags: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, bags), dtype="int64", count=len(bags))
    return np.concatenate([[0], np.cumsum(sizes)]), np.fromiter((t for b in bags for t in b), dtype="int32", count=int(sizes.sum()))


def _sum_rows(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (by entry) over the rows that start at ``starts``."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[starts[1:]] - total[starts[:-1]]


def fit(texts: list[str], labels: list[list[int]], areas: list[str], seed: int = 7) -> Tree:
    """Tree from labelled texts; labels: the areas of each text, by number. With no texts the tree has one bare leaf."""
    rng = np.random.default_rng(seed)
    bags, doc = [], []
    for i, x in enumerate(texts):
        for s in sentences(x):
            t = terms(s)
            if t:
                bags.append(sorted(set(t)))
                doc.append(i)
    count = Counter(t for b in bags for t in b)
    names = [t for t, n in count.items() if n >= TERM_COUNT]
    number = {t: i for i, t in enumerate(names)}
    start, tok = _rows([[number[t] for t in b if t in number] for b in bags])
    doc_of = np.array(doc, dtype="int64")
    k, v = len(areas), len(names)
    has = np.zeros((len(texts), k))
    for i, ls in enumerate(labels):
        has[i, ls] = 1
    prior = has / np.maximum(has.sum(1, keepdims=True), 1)
    base = np.maximum(prior.mean(0) if len(texts) else np.ones(k) / k, 1e-9)
    of = np.repeat(np.arange(len(bags)), np.diff(start))

    def by_term(x: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(tok, weights=x[of, j], minlength=v) for j in range(x.shape[1])], axis=1) if v else np.zeros((0, x.shape[1]))

    # each sentence belongs to the areas of its document in parts; the terms sharpen the parts
    part = prior[doc_of] if len(bags) else np.zeros((0, k))
    n = np.bincount(tok, minlength=v).astype(float)
    for _ in range(5):
        c = by_term(part)
        rate = (c + 3 * base) / (n[:, None] + 3)
        odds = np.log(rate / base)
        score = np.stack([np.bincount(of, weights=odds[tok, j], minlength=len(bags)) for j in range(k)], axis=1) if v and len(bags) else np.zeros((len(bags), k))
        allowed = has[doc_of] if len(bags) else part
        e = np.exp(np.clip(score, -30, 30)) * allowed
        part = e / (1.0 + e.sum(1, keepdims=True))  # the 1 stands for no area at all
    rate = (by_term(part) + 2 * base) / (n[:, None] + 2)
    gain = np.maximum((rate.max(1) - base[rate.argmax(1)]) / (1 - np.minimum(base[rate.argmax(1)], 0.99)), 0) if v else np.zeros(0)  # how far one area stands out
    keep = np.flatnonzero(gain > TERM_WEIGHT)
    renumber = np.full(v, -1)
    renumber[keep] = np.arange(len(keep))
    names, weight = [names[i] for i in keep], gain[keep]
    tok2 = renumber[tok] if v else tok
    ok = tok2 >= 0
    # equal sentences are one point with a weight
    seen: dict[bytes, int] = {}
    which = np.full(len(bags), -1)
    points: list[np.ndarray] = []
    for i in range(len(bags)):
        b = tok2[start[i] : start[i + 1]][ok[start[i] : start[i + 1]]]
        if len(b) and np.sqrt((weight[b] ** 2).sum()) >= LEAST_NORM:
            b = np.sort(b).astype("int32")
            which[i] = seen.setdefault(b.tobytes(), len(points))
            if which[i] == len(points):
                points.append(b)
    used = np.flatnonzero(which >= 0)
    many = np.bincount(which[used], minlength=len(points)).astype(float)
    ps, pt = _rows([p.tolist() for p in points])
    pw = weight[pt].astype("float32") if len(pt) else np.zeros(0, "float32")
    norm = np.sqrt(_sum_rows(pw.astype(float) ** 2, ps))
    pw = (pw / np.repeat(np.maximum(norm, 1e-9), np.diff(ps))).astype("float32")
    vn = len(names)

    lengths = np.diff(ps)

    def entries(sel: np.ndarray) -> np.ndarray:
        """Places of the terms of the chosen points, one point after the other."""
        ends = np.cumsum(lengths[sel])
        return np.arange(ends[-1] if len(sel) else 0) + np.repeat(ps[sel] - (ends - lengths[sel]), lengths[sel])

    def mean(sel: np.ndarray) -> np.ndarray:
        at = entries(sel)
        w = np.repeat(many[sel], lengths[sel])
        c = np.bincount(pt[at], weights=pw[at] * w, minlength=vn)
        return (c / max(np.linalg.norm(c), 1e-9)).astype("float32")

    def cosines(sel: np.ndarray, c: np.ndarray) -> np.ndarray:
        at = entries(sel)
        return _sum_rows((pw[at] * c[pt[at]]).astype(float), np.concatenate([[0], np.cumsum(lengths[sel])]))

    children, centroid, members = [[-1, -1]], [mean(np.arange(len(points)))], {0: np.arange(len(points))}
    todo = [(float(many.sum()), 0)]
    leaves = 1
    while todo and leaves < LEAVES:
        todo.sort()
        size, node = todo.pop()
        sel = members[node]
        if len(sel) < 2 or size < 2 * LEAST or float((cosines(sel, centroid[node]) * many[sel]).sum() / many[sel].sum()) > TIGHT:
            continue
        a = sel[rng.choice(len(sel), p=many[sel] / many[sel].sum())]
        far = cosines(sel, mean(np.array([a])))
        b = sel[int(np.argmin(far + 1e-9 * rng.random(len(sel))))]
        c1, c2 = mean(np.array([a])), mean(np.array([b]))
        side = np.zeros(len(sel), bool)
        for _ in range(8):
            new = cosines(sel, c2) > cosines(sel, c1)
            if new.all() or not new.any() or (new == side).all():
                break
            side = new
            c1, c2 = mean(sel[~side]), mean(sel[side])
        if not side.any() or side.all():
            continue
        children[node] = [len(children), len(children) + 1]
        for s, c in ((sel[~side], c1), (sel[side], c2)):
            members[len(children)] = s
            todo.append((float(many[s].sum()), len(children)))
            children.append([-1, -1])
            centroid.append(c)
        del members[node]
        leaves += 1
    mixture = np.zeros((len(children), k))
    where = np.full(len(points), -1)
    for node, sel in members.items():
        where[sel] = node
    leaf = where[which[used]] if len(used) else np.zeros(0, int)
    for a in range(k):
        mixture[:, a] = np.bincount(leaf, weights=part[used, a], minlength=len(children))
    mixture /= np.maximum(np.bincount(leaf, minlength=len(children)), 1)[:, None]
    return Tree({t: i for i, t in enumerate(names)}, weight.astype("float32"), np.array(children), np.array(centroid, dtype="float16").reshape(len(children), vn), mixture, areas)


def assign(tree: Tree, texts: list[str | None]) -> list[list[str]]:
    """Areas of each text, in the order of ``tree.areas``."""
    bags, doc = [], []
    number = tree.vocabulary
    for i, x in enumerate(texts):
        if x:
            for s in sentences(x):
                b = sorted({number[t] for t in terms(s) if t in number})
                if b:
                    bags.append(b)
                    doc.append(i)
    out: list[set[int]] = [set() for _ in texts]
    if bags:
        start, tok = _rows(bags)
        w = tree.weight[tok].astype(float)
        norm = np.sqrt(_sum_rows(w * w, start))
        of = np.repeat(np.arange(len(bags)), np.diff(start))
        w = w / np.maximum(norm[of], 1e-9)
        at = np.zeros(len(bags), dtype="int64")
        active = norm >= LEAST_NORM
        while True:
            kids = tree.children[at]
            inner = active & (kids[:, 0] >= 0)
            if not inner.any():
                break
            e = inner[of]
            c = [np.bincount(of[e], weights=w[e] * tree.centroid[kids[of[e], j], tok[e]], minlength=len(bags)) for j in (0, 1)]
            at = np.where(inner, np.where(c[1] > c[0], kids[:, 1], kids[:, 0]), at)
        cosine = np.bincount(of, weights=w * tree.centroid[at[of], tok], minlength=len(bags))
        found = (tree.mixture[at] >= SHARE) & (active & (cosine >= LEAST_COSINE))[:, None]
        for b, a in zip(*np.nonzero(found)):
            out[doc[b]].add(int(a))
    return [[tree.areas[a] for a in sorted(s)] for s in out]


def _key(x: str | None) -> str:
    return re.sub(r"[^a-z]+", " ", plain(x or "")).strip()


def learn(documents: DataFrame, labels: DataFrame, areas: DataFrame, sample: int = SAMPLE_DOCS) -> Tree:
    """Tree from at most ``sample`` labelled documents (those of least hash of doc_id).

    Labels name an area by its code or name, in any letter case, with or without accents; others count as none.
    """
    named: dict[str, int] = {}
    codes = []
    for r in areas.select("assunto", "nome").distinct().orderBy("assunto").collect():  # fixed: the list of areas
        codes.append(r["assunto"])
        for x in (r["assunto"], r["nome"]):
            named.setdefault(_key(x), len(codes) - 1)
    sets = labels.filter("doc_id is not null and assunto is not null").groupBy("doc_id").agg(F.collect_set(F.col("assunto")).alias("__labels"))
    some = sets.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = documents.select("doc_id", "text").filter("text is not null and text <> ''").join(F.broadcast(some), "doc_id").orderBy("doc_id").collect()
    texts = [r["text"] for r in rows]
    sets_ = [sorted({named[_key(x)] for x in r["__labels"] if _key(x) in named}) for r in rows]
    kept = [i for i, s in enumerate(sets_) if s]
    return fit([texts[i] for i in kept], [sets_[i] for i in kept], codes)


def subjects(documents: DataFrame, labels: DataFrame, areas: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, assunto): each area that at least a sentence of the document is about.

    Null, empty and blank texts, and texts without such a sentence, give no row. Whole texts are read. With no labels
    no document gets an area. Repeated documents give their rows once each doc_id.
    """
    tree = learn(documents, labels, areas, sample)
    shared = documents.sparkSession.sparkContext.broadcast(tree)  # bounded by LEAVES and the sample's vocabulary
    schema = T.StructType([documents.schema["doc_id"], T.StructField("assunto", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for lo in range(0, len(texts), 1000):
                got = assign(shared.value, texts[lo : lo + 1000])
                at = [lo + i for i, a in enumerate(got) for _ in a]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array([x for a in got for x in a], pa.string())], names=["doc_id", "assunto"])

    got = documents.filter("text is not null and trim(text) <> ''").select("doc_id", "text").mapInArrow(run, schema)
    return got.distinct()


def leaves(tree: Tree) -> pd.DataFrame:
    """Report of the leaves: node, areas, largest share of its mixture, discriminative terms."""
    at = np.flatnonzero(tree.children[:, 0] < 0)
    return pd.DataFrame({"node": at, "assuntos": [", ".join(tree.areas[a] for a in np.flatnonzero(tree.mixture[i] >= SHARE)) for i in at], "parte": tree.mixture[at].max(1) if len(tree.areas) else 0.0, "termos": [", ".join(tree.leaf_terms(i)) for i in at]})
