"""Variant spellings of the names of persons and organisations.

1. Names become vectors of character n-grams, weighted by the square of their inverse document frequency so that what few
   names share counts most. Short forms of given names are learnt from the names themselves and written out in the vectors.
2. A distributed sparse join finds all pairs that reach a cosine: names meet at the n-grams of exact prefixes, where
   whole vectors give the cosine at once. ``nearest`` keeps the top n of each name where that is wanted.
3. Pairs above the threshold are compared part by part, as relatives and sister companies are as near by n-grams as
   variants are; those that don't fit count as cosine 0.
4. Average linkage over the cosines groups the names, in rounds that merge clusters which are each other's nearest.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from erario.llm.increments import _edits
from erario.session import written

#: Length of the n-grams, least cosine of a pair, and least mean cosine of two clusters that are merged.
GRAM, COSINE, LINKAGE = 5, 0.3, 0.1
#: N-grams of fewer names than this weigh alike, so that a slip's own n-grams don't outweigh the words around it.
SATURATED = 20
#: A word is common from this share of all names.
COMMON = 0.002
#: Share from which a surname is too frequent to stand with an initial only.
FREQUENT = 0.0004
#: Weight of words that are taken whole, as abbreviations and initials are, against that of the n-grams of longer ones.
WHOLE = 0.25
#: Bits of the hash by which the postings of a frequent n-gram are cut into blocks, and the postings in a block.
BLOCK_ROWS = 2_000
#: Meetings that are scored at a time.
MEETINGS = 50_000

#: Names that must have a word and another one in its place for it to be a short form, and the share of the names with either that must.
SHORT_SEEN, SHORT_SHARE = 2, 0.7
#: Share of the names from which a word may be a short form, and how much rarer than the full name it must be.
SHORT_USED, SHORT_RARER = 0.00005, 3

# Legal forms and particles.
LEGAL = frozenset("ltda limitada epp me eireli sa".split())
PARTICLES = frozenset("de da do das dos".split())


def form(name: str) -> str:
    """Plain form: lower case, no accents or punctuation, legal form S.A. as one word, the part before a comma last."""
    s = unicodedata.normalize("NFKD", name)
    s = "".join(c for c in s if not unicodedata.combining(c)).lower()
    s = re.sub(r"\bs\s*[./]\s*a\b\.?", " sa ", s)
    if "," in s:
        a, b = s.split(",", 1)
        s = f"{b} {a}"
    return " ".join(re.findall(r"[a-z]+", s.replace("&", " e ")))


def grams(words: str, short: dict[str, str] | None = None) -> list[str]:
    """The distinct n-grams of each word (of the full word for one in ``short``); shorter words are taken whole."""
    out = set()
    for w in words.split():
        w = short.get(w, w) if short else w
        if len(w) <= GRAM:
            out.add(w)
        else:
            out.update(w[i : i + GRAM] for i in range(len(w) - GRAM + 1))
    return sorted(out)


def number(gram: str) -> int:
    """The letters of an n-gram as digits of base 27; each has its own number, shorter ones have smaller numbers."""
    n = 0
    for c in gram:
        n = n * 27 + ord(c) - 96
    return n


def _near(a: str, b: str) -> bool:
    """Equal, or one slip of the keys apart in words of four letters or more."""
    return a == b or (min(len(a), len(b)) >= 4 and _edits(a, b, 1))


def _short(a: str, b: str) -> bool:
    """One is an abbreviation of the other: its beginning, or its letters left out."""
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if not s or s[0] != t[0] or len(s) > 0.8 * len(t):
        return False
    it = iter(t)
    return t.startswith(s) or (len(s) >= 3 and all(c in it for c in s))


class Words:
    """Common words of the names, split into those of organisations and those of persons."""

    def __init__(self, trade: frozenset[str], given: frozenset[str], frequent: frozenset[str] = frozenset(), short: dict[str, str] | None = None):
        self.trade, self.frequent, self.short = trade, frequent, short or {}
        self.given = given | frozenset(self.short.values())

    def full(self, word: str) -> str:
        return self.short.get(word, word)

    def same_given(self, a: str, b: str) -> bool:
        """Whether two given names are one: equal or a slip apart, if not both common, or one short for the other."""
        if _near(a, b):
            return a == b or not (a in self.given and b in self.given)
        fa, fb = self.full(a), self.full(b)
        return fa == fb or (min(len(fa), len(fb)) >= 4 and (fa == a or fb == b) and not (a in self.given and b in self.given) and _edits(fa, fb, 1))

    def organisation(self, words: list[str]) -> bool:
        return any(w in LEGAL or w in self.trade for w in words)

    def parts(self, words: list[str]) -> tuple[list[str], list[str]]:
        """(proper names, trade words) of an organisation; legal forms and particles left out."""
        proper, trade = [], []
        for w in words:
            if w in LEGAL or w in PARTICLES or w == "e":
                continue
            if w in self.trade or (2 < len(w) <= 7 and any(t != w and (t.startswith(w) or len(w) <= 5 and _short(w, t)) for t in self.trade)) or any(len(w) > 5 and _edits(w, t, 1) for t in self.trade if t[0] == w[0] or t[1:3] == w[1:3]):
                trade.append(w)
            else:
                proper.append(w)
        return proper, trade


def _proper(a: list[str], b: list[str]) -> bool:
    if not a or not b:
        return False
    x, y = "".join(a), "".join(b)
    if x == y or (min(len(x), len(y)) >= 8 and _edits(x, y, 1)):
        return True
    if len(a) == len(b):
        same = [_near(p, q) for p, q in zip(a, b)]
        if all(same):
            return True
        initial = [len(p) == 1 and q.startswith(p) or len(q) == 1 and p.startswith(q) for p, q in zip(a, b)]
        return len(a) > 1 and all(s or i for s, i in zip(same, initial)) and any(same)
    # one written together, with a slip in it
    return min(len(a), len(b)) == 1 and min(len(x), len(y)) >= 10 and _edits(x, y, 2)


def _trades(a: list[str], b: list[str]) -> bool:
    """The shorter list of trade words is contained in the other, but for abbreviations and slips; none fits any."""
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    left = list(t)
    for w in s:
        hit = next((x for x in left if _near(w, x)), None) or next((x for x in left if _short(w, x)), None)
        if hit is None:
            return False
        left.remove(hit)
    return True


def _persons(a: list[str], b: list[str], words: Words) -> bool:
    a, b = [w for w in a if w not in PARTICLES], [w for w in b if w not in PARTICLES]
    if len(a) < 2 or len(b) < 2:
        return a == b
    if len(a) > len(b):
        a, b = b, a
    if not words.same_given(a[0], b[0]):
        return False
    if not _near(a[-1], b[-1]):
        # surnames written together
        return len(a) < len(b) and _near(a[-1], b[-2] + b[-1]) and _middle(a[1:-1], b[1:-2], words)[0]
    ok, full = _middle(a[1:-1], b[1:-1], words)
    return ok and (full or len(a) == len(b) == 2 or a[-1] not in words.frequent and b[-1] not in words.frequent)


def _middle(a: list[str], b: list[str], words: Words) -> tuple[bool, bool]:
    """Whether the middle names fit in order, and whether one of them does in full. Only a given name may be missing."""
    i, full = 0, False
    for w in b:
        if i < len(a):
            v = a[i]
            if _near(v, w) and not (v in words.given and w in words.given and v != w) or words.full(v) == words.full(w):
                i, full = i + 1, True
                continue
            if len(v) == 1 and w.startswith(v) or len(w) == 1 and v.startswith(w):
                i += 1
                continue
        if w not in words.given and w not in words.short and len(w) > 1:
            return False, False
    return i == len(a), full


def same(a: str, b: str, words: Words) -> bool:
    """Whether two plain forms stand for one person or organisation as far as their parts tell."""
    if a == b:
        return True
    x, y = a.split(), b.split()
    org = words.organisation(x), words.organisation(y)
    if org[0] != org[1]:
        return False
    if not org[0]:
        return _persons(x, y, words)
    (pa, ta), (pb, tb) = words.parts(x), words.parts(y)
    return _proper(pa, pb) and _trades(ta, tb)


def vocabulary(forms: DataFrame) -> Words:
    """Words that at least COMMON (FREQUENT) of the forms hold: at most (words of a name) / FREQUENT of them."""
    n = forms.count()
    legal = F.arrays_overlap(F.split("forma", " "), F.array(*[F.lit(x) for x in sorted(LEGAL)])).cast("int")
    w = forms.select(F.explode(F.array_distinct(F.split("forma", " "))).alias("w"), legal.alias("l"), F.element_at(F.split("forma", " "), 1).alias("head")).groupBy("w")
    rows = w.agg(F.count("*").alias("n"), F.avg("l").alias("l"), F.avg((F.col("head") == F.col("w")).cast("int")).alias("h")).filter(F.col("n") >= F.lit(max(3, FREQUENT * n))).collect()
    frequent = frozenset(r["w"] for r in rows if r["n"] >= max(12, FREQUENT * n))
    rows = [r for r in rows if r["n"] >= COMMON * n]
    fixed = LEGAL | PARTICLES | {"e"}
    trade = frozenset(r["w"] for r in rows if r["l"] >= 0.9 and r["w"] not in fixed and len(r["w"]) > 3 and not (r["h"] > 0.5))
    given = frozenset(r["w"] for r in rows if r["l"] < 0.1 and r["w"] not in fixed and len(r["w"]) > 2 and r["h"] > 0.2)
    return Words(trade, given, frequent, short_forms(forms, given, n))


def short_forms(forms: DataFrame, given: frozenset[str], n: int) -> dict[str, str]:
    """Short form -> common given name, learnt from the names.

    A first word is short for a common given name if most names that have their surnames (two or more) in common with a
    name that begins with a common given name have that one. Words of fewer than SHORT_USED of the ``n`` names aren't, so there are at most
    (words of a name) / SHORT_USED of them.
    """
    if not given:
        return {}
    w = F.filter(F.split("forma", " "), lambda x: ~x.isin(*sorted(PARTICLES)))
    persons = forms.select(w.alias("w")).filter((F.size("w") > 1) & ~F.arrays_overlap("w", F.array(*[F.lit(x) for x in sorted(LEGAL)])))
    surnames = F.array_sort(F.filter(F.slice("w", 2, 1_000_000), lambda x: (F.length(x) > 1) & ~x.isin(*sorted(given))))
    heads = persons.select(F.get("w", 0).alias("h"), surnames.alias("s")).filter(F.size("s") > 1).select("h", F.xxhash64("s").alias("rest")).distinct()
    used = heads.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= F.lit(max(2.0, SHORT_USED * n)))
    many = heads.join(used, "h")
    full = many.filter(F.col("h").isin(*sorted(given))).select(F.col("h").alias("full"), "rest", F.col("n").alias("nf"))
    met = many.filter(F.length("h") > 1).join(full, "rest").filter(F.col("n") * SHORT_RARER <= F.col("nf"))
    both = met.groupBy("h", "full").agg(F.count("*").alias("n"))
    of = met.select("h", "rest").distinct().groupBy("h").agg(F.count("*").alias("all"))
    rows = both.join(of, "h").filter((F.col("n") >= SHORT_SEEN) & (F.col("n") >= SHORT_SHARE * F.col("all"))).collect()  # bounded by SHORT_USED
    return {r["h"]: r["full"] for r in sorted(rows, key=lambda r: (r["n"], r["full"]))}


def _vectors(forms: DataFrame, n: int, short: dict[str, str] | None = None) -> DataFrame:
    """(id, forma, gs, dfs, ws): the n-grams of each of the ``n`` forms, the number of their names and their weights, heaviest first."""
    g = forms.select("id", F.explode(_grams_udf(short)(F.col("forma"))).alias("g"))
    df = g.groupBy("g").agg(F.count("*").alias("df"))
    own = g.join(df, "g").groupBy("id").agg(F.collect_list(F.struct("g", "df")).alias("v"))
    idf = lambda x: F.log(F.lit(n + SATURATED) / F.greatest(x["df"], F.lit(SATURATED)))
    weight = lambda x: idf(x) * idf(x) * F.when(x["g"] < F.lit(27 ** (GRAM - 1)), F.lit(WHOLE)).otherwise(F.lit(1.0))
    # Spark's logarithm is the same on all machines, so all vectors have one order
    heavy = F.array_sort(F.transform("v", lambda x: F.struct((-weight(x)).alias("w"), x["g"].alias("g"), x["df"].alias("df"))))
    v = own.select("id", heavy.alias("v")).join(forms.select("id", "forma"), "id")
    return v.select("id", "forma", F.col("v.g").alias("gs"), F.col("v.df").alias("dfs"), F.transform("v.w", lambda x: -x).alias("ws"))


def _packed(gs: np.ndarray, dfs: np.ndarray) -> bytes:
    """N-grams and the number of their names; bytes of like rank stand together, as they compress better so."""
    return np.stack([gs, dfs], axis=1).astype("<i4").view("u1").T.tobytes()


def _unpacked(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams, numbers of their names, number of n-grams of each) of packed vectors."""
    x = np.concatenate([np.frombuffer(b, "u1").reshape(8, -1) for b in packed], axis=1)
    both = np.ascontiguousarray(x.T).view("<i4")
    return both[:, 0], both[:, 1], np.fromiter((len(b) // 8 for b in packed), "i8", len(packed))


def _postings(cosine: float):
    """Rows (g, df, id, forma, r, norm, v) for the n-grams that can be the first one shared with a form as near as ``cosine``.

    r: norm of that n-gram and the lighter ones, as a share of ``norm``; v: the packed n-grams that other forms have too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gs, dfs, ws = (batch.column(c).flatten().to_numpy() for c in ("gs", "dfs", "ws"))
            size = np.diff(batch.column("gs").offsets.to_numpy())
            if not len(gs):
                continue
            end = np.cumsum(size)
            row = np.repeat(np.arange(len(size)), size)
            norm = np.sqrt(np.add.reduceat(ws * ws, end - size))
            us = ws / norm[row]
            done = np.cumsum(us * us)
            r = np.sqrt(np.maximum(done[end - 1][row] - done + us * us, 0.0))
            shared = dfs > 1
            v = [_packed(gs[a:z][shared[a:z]], dfs[a:z][shared[a:z]]) for a, z in zip(end - size, end)]
            at = np.flatnonzero(shared & (r >= cosine - 1e-9))
            of = pa.array(row[at])
            yield pa.RecordBatch.from_arrays([pa.array(gs[at]), pa.array(dfs[at]), batch.column("id").take(of), batch.column("forma").take(of), pa.array(r[at]), pa.array(norm[row[at]]), pa.array(v, pa.binary()).take(of)], ["g", "df", "id", "forma", "r", "norm", "v"])

    return run


def _meetings(n: int, cosine: float, words: Words | None):
    """Rows (a, b, s) for postings of ``n`` forms that come in the order of their group (g, i, j) and from the greatest r."""

    def met(t: pa.Table) -> Iterator[pa.RecordBatch]:
        g, i, j, own, r, ids = (t[c].to_numpy() for c in ("g", "i", "j", "own", "r", "id"))
        first = np.r_[True, (g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
        group = 2.0 * np.cumsum(first)
        # of those behind it, a posting meets the ones whose r is great enough
        here = np.arange(len(g))
        count = np.maximum(np.searchsorted(group - r, group - (cosine - 1e-9) / r, "right") - here - 1, 0)
        total = np.cumsum(count)
        if not total[-1]:
            return
        forms = t["forma"].to_pylist() if words else []
        gs, dfs, size = _unpacked(t["v"].to_pylist())
        start = np.cumsum(size) - size
        us = np.log((n + SATURATED) / np.maximum(dfs, SATURATED)) ** 2 * np.where(gs < 27 ** (GRAM - 1), WHOLE, 1.0) / np.repeat(t["norm"].to_numpy(), size)
        key = (np.repeat(here, size) << 32) | gs
        order = np.argsort(key)
        sorted_key, sorted_us = key[order], us[order]
        begin = 0
        while begin < len(g):
            stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + MEETINGS, "right")))
            c = count[begin:stop]
            p = np.repeat(here[begin:stop], c)
            q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c)
            begin = stop
            keep = (i[p] == j[p]) | (own[p] != own[q])
            p, q = p[keep], q[keep]
            if not len(p):
                continue
            # each n-gram of p is looked up among those of q
            k = size[p]
            pair = np.repeat(np.arange(len(p)), k)
            at = np.repeat(start[p] - np.cumsum(k) + k, k) + np.arange(len(pair))
            want = (q[pair] << 32) | gs[at]
            found = np.minimum(np.searchsorted(sorted_key, want), len(sorted_key) - 1)
            hit = np.flatnonzero(sorted_key[found] == want)
            pair, at = pair[hit], at[hit]
            s = np.bincount(pair, us[at] * sorted_us[found[hit]], len(p))
            # a pair is told once, where its first common n-gram is
            heads = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            at_first = np.zeros(len(p), bool)
            at_first[pair[heads]] = gs[at[heads]] == g[p[pair[heads]]]
            ok = np.flatnonzero(at_first & (s >= cosine - 1e-9))
            if words:
                ok = np.array([x for x in ok if same(forms[p[x]], forms[q[x]], words)], "i8")
            if len(ok):
                x, y = ids[p[ok]], ids[q[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(s[ok])], ["a", "b", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # begins with a group, whose end may be still to come
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = [pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, batch.num_rows - 1)).to_numpy(False) for c in ("g", "i", "j")]
            cut = np.flatnonzero(ends[0] | ends[1] | ends[2])
            at = int(cut[-1]) + 1 if len(cut) else 0
            if at:
                yield from met(pa.Table.from_batches([*rest, batch.slice(0, at)]))
                rest = []
            elif rest and any(rest[-1].column(c)[-1] != batch.column(c)[0] for c in ("g", "i", "j")):
                yield from met(pa.Table.from_batches(rest))
                rest = []
            rest.append(batch.slice(at))
        if rest:
            yield from met(pa.Table.from_batches(rest))

    return run


def similar_pairs(forms: DataFrame, cosine: float = COSINE, short: dict[str, str] | None = None, words: Words | None = None) -> DataFrame:
    """(a, b, s): ids of all forms whose n-gram vectors reach the cosine s, a < b, each pair once.

    forms: id, forma. words: only the pairs whose parts agree. Exact: all vectors have their n-grams in one order,
    heaviest first. Two forms share nothing ahead of their first common n-gram, so their cosine is at most the product of
    the norms from there on; where this product is below the cosine the n-gram can't be the first one that two such forms
    share, and they don't meet there (so n-grams of many names, which are light, make few meetings). Postings hold the
    whole vector of their form: what meets is scored at once, so only postings are shuffled, never the pairs that meet,
    of which there are far more. Postings of a frequent n-gram are cut into blocks, and each two blocks meet apart from
    the others, so no n-gram is one task's load.
    """
    n = forms.count()
    p = _vectors(forms, n, short).mapInArrow(_postings(cosine), "g bigint, df bigint, id bigint, forma string, r double, norm double, v binary")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("df") / BLOCK_ROWS)).cast("int")
    p = p.select("g", "id", *(["forma"] if words else []), "r", "norm", "v", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    p = p.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")
    p = p.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", F.desc("r"))
    return p.mapInArrow(_meetings(n, cosine, words), "a bigint, b bigint, s double")


def nearest(pairs: DataFrame, n: int) -> DataFrame:
    """The pairs (a, b, s) that are among the ``n`` of greatest s of one of their ends; ties are all kept.

    This loses links of names with more than ``n`` variants; ``entities`` takes it only where it is asked for.
    """
    ends = pairs.select(F.explode(F.array(F.col("a"), F.col("b"))).alias("__id"), "a", "b", "s")
    rank = F.rank().over(Window.partitionBy("__id").orderBy(F.desc("s")))
    return ends.withColumn("__r", rank).filter(F.col("__r") <= n).select("a", "b", "s").distinct()


def _grams_udf(short: dict[str, str] | None):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def split(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [number(g) for g in grams(x, short)])

    return split


def _form_udf():
    @F.pandas_udf(T.StringType())
    def plain(s: pd.Series) -> pd.Series:
        return s.map(lambda x: form(x) if x else "")

    return plain


def agreeing(pairs: DataFrame, forms: DataFrame, words: Words) -> DataFrame:
    """(a, b, s): the pairs (a, b, s) whose parts agree."""
    named = pairs.join(forms.select(F.col("id").alias("a"), F.col("forma").alias("fa")), "a").join(forms.select(F.col("id").alias("b"), F.col("forma").alias("fb")), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [same(x, y, words) for x, y in zip(pdf["fa"], pdf["fb"])]
            yield pdf.loc[ok, ["a", "b", "s"]]

    return named.select("a", "b", "s", "fa", "fb").mapInPandas(run, "a bigint, b bigint, s double")


def average_linkage(links: DataFrame, least: float = LINKAGE, rounds: int = 200) -> DataFrame:
    """(id, grupo) of every id in ``links`` (a, b, s): clusters of average linkage, named by an id of theirs.

    Pairs that aren't in ``links`` have similarity 0. Each round merges clusters that are each other's nearest by mean
    similarity (ties by a hash of the pair); as average linkage is reducible, the order of such merges doesn't matter.
    It ends when no two clusters have a mean similarity of ``least``; RuntimeError where that takes over ``rounds``.
    """
    edges = written(links.select("a", "b", "s"), "linkage")
    group = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct().select("id", F.col("id").alias("grupo"), F.lit(1).alias("n"))
    members = written(group, "linkage")
    for _ in range(rounds):
        size = members.groupBy("grupo").agg(F.count("*").alias("n"))
        e = edges.join(size.select(F.col("grupo").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("grupo").alias("b"), F.col("n").alias("nb")), "b")
        e = e.withColumn("m", F.col("s") / (F.col("na") * F.col("nb"))).filter(F.col("m") >= least - 1e-9)
        both = e.select("a", "b", "m", F.xxhash64("a", "b").alias("h")).withColumn("ends", F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).select(F.explode("ends").alias("p"), "m", "h", "a", "b")
        best = both.groupBy("p.x").agg(F.max_by(F.struct("a", "b"), F.struct("m", "h")).alias("e"))
        merge = best.groupBy("e").count().filter("count = 2").select(F.col("e.b").alias("old"), F.col("e.a").alias("new"))
        merge = written(merge, "linkage")
        if merge.isEmpty():
            return members.select("id", "grupo")
        rename = lambda d, c: d.join(merge.withColumnRenamed("old", c), c, "left").withColumn(c, F.coalesce("new", c)).drop("new")
        edges = written(rename(rename(edges, "a"), "b").filter("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("s").alias("s")), "linkage")
        members = written(rename(members, "grupo").select("id", "grupo", "n"), "linkage")
    raise RuntimeError(f"no end of average linkage after {rounds} rounds")


def current_names(creditors: DataFrame) -> DataFrame:
    """(cnpj_cpf, forma): the current name of each creditor in plain form; the latest version where none is current.

    Null and blank keys and names without a letter stand for nobody and are left out.
    """
    rows = creditors.filter("trim(cnpj_cpf) <> '' and nome is not null")
    last = rows.groupBy("cnpj_cpf").agg(F.max(F.struct(F.coalesce("versao_atual", F.lit(False)).alias("v"), "valido_de", "carregado_em", "nome")).alias("l"))
    return last.select("cnpj_cpf", _form_udf()(F.col("l.nome")).alias("forma")).filter("forma <> ''")


def entities(creditors: DataFrame, top: int | None = None) -> DataFrame:
    """(cnpj_cpf, entidade, formas): the entity of each creditor and how many spellings it has.

    Equal plain forms are one point, so copies cost nothing; creditors with one form are one entity. top: compare each
    form with so many nearest ones only (null: with all that reach the cosine).
    """
    names = written(current_names(creditors), "names")
    forms = written(names.select("forma").distinct().withColumn("id", F.xxhash64("forma")), "names")
    words = vocabulary(forms)
    if top is None:
        links = similar_pairs(forms, short=words.short, words=words)
    else:
        links = agreeing(nearest(similar_pairs(forms, short=words.short), top), forms, words)
    groups = average_linkage(links)
    own = forms.join(groups, "id", "left").select("forma", F.coalesce("grupo", "id").alias("entidade"))
    many = own.groupBy("entidade").agg(F.count("*").alias("formas"))
    return names.join(own, "forma").join(many, "entidade").select("cnpj_cpf", "entidade", "formas")


def pairs(creditors: DataFrame) -> DataFrame:
    """(cnpj_cpf_a, cnpj_cpf_b): each pair of different creditors of one entity, a < b as strings.

    The number of pairs is that of an entity's creditors squared, as the result asks; where membership will do, take
    ``entities``. The pairs of a large entity are made in as many tasks as it has blocks of its creditors.
    """
    e = written(entities(creditors).select("cnpj_cpf", "entidade"), "entities")
    size = e.groupBy("entidade").agg(F.count("*").alias("n")).filter("n > 1").select("entidade", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("__n"))
    rows = e.join(size, "entidade").withColumn("__b", F.pmod(F.xxhash64("cnpj_cpf"), F.col("__n")).cast("int"))
    x = rows.select("entidade", F.col("cnpj_cpf").alias("cnpj_cpf_a"), F.col("__b").alias("__i"), F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("__j"))
    y = rows.select("entidade", F.col("cnpj_cpf").alias("cnpj_cpf_b"), F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("__i"), F.col("__b").alias("__j"))
    return x.join(y, ["entidade", "__i", "__j"]).filter("cnpj_cpf_a < cnpj_cpf_b").select("cnpj_cpf_a", "cnpj_cpf_b")
