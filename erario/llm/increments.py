"""Rows of new batches that repeat something already accepted, by immutable suffix arrays.

``History`` is a folder of segments. A segment holds, shard by shard, the texts of the records of one batch, one after
the other, and their suffix array: the places where a record or one of its words begins, in the order of what follows
there. Accepting a batch

1. makes its segment, which is never changed again;
2. looks up substrings of the batch's records in that segment and in the older ones by binary search. A record has two
   texts: its identity (``ano:id``), and the fields that must be equal followed by its description. A match that runs
   through the whole identity, or through all of those fields, makes an older record a candidate; matches of LEAST
   letters or more at the description's words are added up to the coverage of the record by each candidate. What is
   covered to ALIKE is a repetition; of the others an exact comparison of the words decides;
3. merges segments of like size before the next batch is taken, so a history of n batches has about log n of them.

The rows of older batches are never read again, only segments are. Texts go to shards by their leading fields and the
value (in blocks of ten units of money), so a lookup meets all it could match in one shard, or two at the edge of a block. Equal texts of a
batch are stored once, with the first row that has them, which bounds what a commitment that a third of the rows repeat
brings to a shard; leading fields with more distinct texts than half a shard are spread over several, and sought in each.
"""

from __future__ import annotations

import bisect
import functools
import json
import uuid
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.functions.keys import stripped
from erario.operators.compaction import swap_into_place
from erario.operators.ranges import matching_groups
from erario.operators.relational import lookup
from erario.session import drop_on_exit, shared_dir, written

#: Texts that a shard holds on average, and batches that ``repeated`` cuts a whole history into (runs of whole loads).
SHARD_ROWS, BATCHES = 20_000, 3
#: Bytes by which the suffixes at records and at words are ordered; longer leading fields are stored as a digest.
WIDE, NARROW, LONGEST = 128, 24, 96
#: Letters that a match of a description has at least, and the share of two descriptions that must agree.
LEAST, ALIKE = 8, 0.58
#: Bits of the block of values (in cents) that share a shard.
BLOCK_BITS = 10
#: Letters with accents and their plain forms.
_ACCENTS = "áàâãäåéèêëíìîïóòôõöúùûüçñ", "aaaaaaeeeeiiiiooooouuuucn"


class Segment:
    """Suffix array over the concatenated texts of records.

    text: all texts; start: where each record's text begins; suffix: places where a record or a word begins, in the order
    of what follows up to the record's end; owner: the record of each such place; ordem, linha, valor, place: of each
    record. Texts begin with a sign that sorts before all letters, so the records come first in the suffix array. They are
    ordered by WIDE bytes, words by NARROW ones.
    """

    FIELDS = {"text": "u1", "start": "i4", "suffix": "i4", "ordem": "i8", "linha": "i8", "valor": "f8", "place": "i8"}
    SCHEMA = "shard int, " + ", ".join(f"{f} binary" for f in FIELDS)

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)
        if "owner" not in arrays:
            self.owner = (np.searchsorted(self.start, self.suffix, "right") - 1).astype("i4")
        self.whole = self.text.tobytes()
        self.ends = np.append(self.start[1:], len(self.text))
        self.records = len(self.start)

    def slices(self, suffix: np.ndarray, owner: np.ndarray, wide: int) -> np.ndarray:
        """What follows each place, up to ``wide`` bytes and the record's end."""
        if not len(suffix):
            return np.zeros(0, f"S{wide}")
        rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([self.text, np.zeros(wide, "u1")]), wide)[suffix]
        left = self.ends[owner] - suffix
        short = np.flatnonzero(left < wide)
        rows[short] *= np.arange(wide) < left[short, None]
        return rows.view(f"S{wide}").ravel()

    @functools.cached_property
    def heads(self) -> np.ndarray:
        return self.slices(self.suffix[: self.records], self.owner[: self.records], WIDE)

    @functools.cached_property
    def words(self) -> np.ndarray:
        return self.slices(self.suffix[self.records :], self.owner[self.records :], NARROW)

    @classmethod
    def of(cls, heads: Iterable[str], bodies: Iterable[str], ordem, linha, valor, place) -> Segment:
        """Segment of the texts head + body; words of the body begin at its start and after blanks."""
        hs, bs = [x.encode() for x in heads], [x.encode() + b"\n" for x in bodies]
        size = np.array([len(h) + len(b) for h, b in zip(hs, bs)], "i8")
        start = (np.cumsum(size) - size).astype("i4")
        body = start + np.array([len(h) for h in hs], "i4")
        text = np.frombuffer(b"".join(h + b for h, b in zip(hs, bs)), "u1")
        blank = np.flatnonzero(text == 32) + 1
        of_blank = np.searchsorted(start, blank, "right") - 1
        inner = blank > body[of_blank] if len(blank) else np.zeros(0, bool)
        worded = np.array([len(b) > 1 for b in bs], bool)
        n = np.arange(len(hs))
        word, of_word = np.concatenate([body[worded], blank[inner]]), np.concatenate([n[worded], of_blank[inner]])
        out = cls(text=text, start=start, suffix=start, owner=n, ordem=np.asarray(ordem, "i8"), linha=np.asarray(linha, "i8"), valor=np.asarray(valor, "f8"), place=np.asarray(place, "i8"))
        a, b = np.argsort(out.heads, kind="stable"), np.argsort(out.slices(word, of_word, NARROW), kind="stable")
        return cls(**{f: getattr(out, f) for f in cls.FIELDS} | {"suffix": np.concatenate([start[a], word[b]]).astype("i4")}, owner=np.concatenate([n[a], of_word[b]]).astype("i4"))

    @classmethod
    def read(cls, row) -> Segment:
        return cls(**{f: np.frombuffer(row[f], t) for f, t in cls.FIELDS.items()})

    def row(self, shard: int) -> dict:
        return {"shard": shard} | {f: np.ascontiguousarray(getattr(self, f), t).tobytes() for f, t in self.FIELDS.items()}

    def part(self, keep: np.ndarray) -> Segment:
        """The records that ``keep`` marks, their suffixes in the order they have."""
        number = np.cumsum(keep) - 1
        size = (self.ends - self.start)[keep]
        start = np.cumsum(size) - size
        text = self.text[np.repeat(keep, self.ends - self.start)]
        s = keep[self.owner]
        shift = start - self.start[keep]
        return Segment(text=text, start=start.astype("i4"), suffix=(self.suffix[s] + shift[number[self.owner[s]]]).astype("i4"), owner=number[self.owner[s]].astype("i4"), ordem=self.ordem[keep], linha=self.linha[keep], valor=self.valor[keep], place=self.place[keep])

    def merged(self, other: Segment) -> Segment:
        """Both texts in one; the sorted suffixes are interleaved, not sorted again."""
        suffix, owner = [], []
        for mine, its, lo, hi in ((self.heads, other.heads, slice(0, self.records), slice(0, other.records)), (self.words, other.words, slice(self.records, None), slice(other.records, None))):
            at = np.searchsorted(mine, its, "right") + np.arange(len(its))
            old = np.ones(len(mine) + len(its), bool)
            old[at] = False
            s, o = np.empty(len(old), "i4"), np.empty(len(old), "i4")
            s[old], s[at] = self.suffix[lo], other.suffix[hi] + len(self.text)
            o[old], o[at] = self.owner[lo], other.owner[hi] + self.records
            suffix.append(s)
            owner.append(o)
        both = lambda f: np.concatenate([getattr(self, f), getattr(other, f)])
        return Segment(text=both("text"), start=np.concatenate([self.start, other.start + len(self.text)]).astype("i4"), suffix=np.concatenate(suffix), owner=np.concatenate(owner), ordem=both("ordem"), linha=both("linha"), valor=both("valor"), place=both("place"))

    def beginning(self, prefixes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each prefix the range of records, in the suffix array, that begin with it."""
        return np.searchsorted(self.heads, np.array(prefixes, f"S{WIDE + 1}"), "left"), np.searchsorted(self.heads, np.array([p + b"\xff" for p in prefixes], f"S{WIDE + 1}"), "left")

    def holding(self, part: bytes) -> tuple[int, int]:
        """The range of the suffix array whose words begin with ``part`` (up to NARROW bytes)."""
        at = lambda k: self.whole[self.suffix[k] : min(self.suffix[k] + len(part), self.ends[self.owner[k]])]
        places = range(self.records, len(self.suffix))
        lo = bisect.bisect_left(places, part, key=at)
        return self.records + lo, self.records + bisect.bisect_right(places, part, lo=lo, key=at)

    def body(self, record: int) -> bytes:
        return self.whole[self.start[record] : self.ends[record]].rsplit(b"|", 1)[-1].rstrip(b"\n")

    def coverage(self, body: bytes, candidates: list[int]) -> dict[int, int]:
        """Letters of the words of ``body`` that lie within matches of LEAST letters or more with each candidate."""
        words, at = body.split(b" "), 0
        begin = []
        for w in words:
            begin.append(at)
            at += len(w) + 1
        text = body + b"\n"
        sought = [(j, text[j : j + LEAST]) for j in begin if len(text) - j >= LEAST]
        wanted = np.zeros(len(self.start), bool)
        wanted[candidates] = True
        covered: dict[int, set[int]] = {r: set() for r in candidates}
        for j, part in sought:
            lo, hi = self.holding(part)
            for k in lo + np.flatnonzero(wanted[self.owner[lo:hi]]):
                here = self.suffix[k]
                there = self.whole[here : here + len(text) - j]
                mine = text[j:]
                n = len(mine) if mine == there else next((i for i, (x, y) in enumerate(zip(mine, there)) if x != y), min(len(mine), len(there)))
                # whole words only: a word ends there too
                end = j + n - (there[n : n + 1] not in (b" ", b"\n", b""))
                covered[int(self.owner[k])].update(i for i, b in enumerate(begin) if b >= j and b + len(words[i]) <= end)
        return {r: sum(len(words[i]) for i in c) for r, c in covered.items()}


def _edits(a: str, b: str, most: int) -> bool:
    """Whether ``a`` becomes ``b`` by at most ``most`` insertions, deletions, changes or swaps of neighbours."""
    if abs(len(a) - len(b)) > most:
        return False
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            c = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                c = min(c, before[j - 2] + 1)
            new.append(c)
        if min(new) > most:
            return False
        before, row = row, new
    return row[-1] <= most


def same_word(a: str, b: str) -> bool:
    """Equal, one an abbreviation of the other, or a slip of the keys apart."""
    if a == b:
        return True
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if s[0] == t[0] and len(s) <= 0.75 * len(t):
        it = iter(t)
        if all(c in it for c in s):
            return True
    return len(t) >= 4 and _edits(s, t, 1 if len(t) < 7 else 2)


def alike(a: list[str], b: list[str]) -> float:
    """Share of the letters of two word lists, of the one with more letters, whose words have a partner in the other."""
    if sum(map(len, a)) < sum(map(len, b)):
        a, b = b, a
    total = sum(map(len, a))
    if not total:
        return 1.0 if a == b else 0.0
    rest = Counter(b)
    got, left = 0, []
    for w in a:
        if rest[w]:
            rest[w] -= 1
            got += len(w)
        else:
            left.append(w)
    free = list(rest.elements())
    for w in left:
        for i, x in enumerate(free):
            if same_word(w, x):
                got += len(w)
                del free[i]
                break
    return got / total


def whole_number(c: Column) -> Column:
    """A text as the whole number it is written for, null without one above zero.

    Blanks around it, zeros before it, points between groups of three digits and zero decimals don't count.
    """
    t = stripped(c)
    plain = F.when(t.rlike(r"^[0-9]+$"), t).when(t.rlike(r"^[0-9]{1,3}(\.[0-9]{3})+(,0+)?$"), F.replace(F.regexp_replace(t, r",0+$", ""), F.lit("."))).when(t.rlike(r"^[0-9]+[.,]0+$"), F.regexp_replace(t, r"[.,]0+$", ""))
    n = F.ltrim(plain, F.lit("0"))
    return F.when((n != "") & (F.length(n) <= 18), n.try_cast("bigint"))


def day_of(c: Column) -> Column:
    """Day of a text that starts as yyyy-mm-dd or is dd/mm/yyyy; null for any other."""
    t = stripped(c)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))
    return F.coalesce(iso, F.when(t.rlike(r"^\d{2}/\d{2}/\d{4}"), F.try_to_date(F.substring(t, 1, 10), "dd/MM/yyyy")))


def _words(c: Column) -> Column:
    low = F.translate(F.lower(F.coalesce(c, F.lit(""))), *_ACCENTS)
    # combining marks, if any, stand within a word
    return F.trim(F.regexp_replace(F.when(low.rlike(r"\p{M}"), F.regexp_replace(low, r"\p{M}+", "")).otherwise(low), "[^a-z]+", " "))


def prepared(rows: DataFrame, loads: DataFrame) -> DataFrame:
    """(linha_id, ordem, identidade, chave, centavos, palavras) of commitments as received.

    ordem: day and number of the load (then linha_id decides); loads that aren't in the register come last. identidade:
    ``ano:id`` or null where the id was lost. chave: the fields that must be equal (their digest where they are longer than
    LONGEST bytes), null unless all of them and valor are known; the numbers of the description are part of it.
    """
    rows = rows.select("linha_id", "carga_id", "id", "ano", "dataemissao", "codigoug", "codigocredor", "codprocesso", "valor", "historico")
    days = loads.filter("carga_id is not null").groupBy("carga_id").agg(F.min(day_of(F.col("data_extracao"))).alias("__dia"))
    with_day = lookup(rows, days, ["carga_id"])
    # in steps, so that what is used more than once is made once
    first = with_day.select(
        "linha_id", "ano", "historico", stripped(F.col("id")).alias("__id"), *[stripped(F.col(c)).alias(f"__k{i}") for i, c in enumerate(("codigoug", "codigocredor", "codprocesso"))],
        day_of(F.col("dataemissao")).alias("__day"), F.col("valor").cast("double").alias("valor"), F.round(F.col("valor").cast("double") * 100).try_cast("bigint").alias("centavos"),
        (F.coalesce(F.date_format("__dia", "yyyyMMdd").try_cast("bigint"), F.lit(99999999)) * 10**10 + F.coalesce(F.col("carga_id"), F.lit(10**10 - 1))).alias("ordem"),
    )
    known = (F.col("__k0") != "") & (F.col("__k1") != "") & (F.col("__k2") != "") & F.col("__day").isNotNull() & F.col("centavos").isNotNull()
    second = first.withColumns({"__known": F.coalesce(known, F.lit(False)), "__number": whole_number(F.col("__id"))})
    numbers = F.array_join(F.array_sort(F.transform(F.regexp_extract_all(F.coalesce("historico", F.lit("")), F.lit(r"(\d+)"), 1), lambda x: F.coalesce(F.nullif(F.ltrim(x, F.lit("0")), F.lit("")), F.lit("0")))), ",")
    third = second.withColumn("__text", F.when(F.col("__known"), F.concat_ws("|", "__k0", "__k1", "__k2", F.col("__day").cast("string"), numbers)))
    return third.select(
        "linha_id", "ordem", F.when(F.col("__number").isNotNull() & F.col("ano").isNotNull(), F.concat_ws(":", "ano", "__number")).alias("identidade"),
        F.when(F.octet_length("__text") > LONGEST, F.md5("__text")).otherwise(F.col("__text")).alias("chave"),
        F.when(F.col("__known"), F.col("centavos")).alias("centavos"), F.when(F.col("__known"), _words(F.col("historico"))).alias("palavras"), F.when(F.col("__known"), F.col("valor")).alias("valor"),
    )


def entries(p: DataFrame) -> DataFrame:
    """(cabeca, centavos, palavras, ordem, linha_id, valor, n): the distinct texts of a prepared batch, their first row and their number."""
    place = F.struct("ordem", "linha_id", "valor")
    out = texts(p).groupBy("cabeca", "centavos", "palavras").agg(F.min(place).alias("f"), F.count("*").alias("n"))
    return out.select("cabeca", "centavos", "palavras", "f.ordem", "f.linha_id", F.coalesce("f.valor", F.lit(0.0)).alias("valor"), "n")


def texts(p: DataFrame) -> DataFrame:
    """(cabeca, centavos, palavras, ordem, linha_id, valor): one row for each of the two texts a prepared row may have."""
    identity = F.when(F.col("identidade").isNotNull(), F.struct(F.concat(F.lit("#"), "identidade").alias("cabeca"), F.lit(0).cast("bigint").alias("centavos"), F.lit("").alias("palavras")))
    content = F.when(F.col("chave").isNotNull(), F.struct(F.concat(F.lit("="), "chave").alias("cabeca"), F.col("centavos"), F.col("palavras")))
    return p.select("ordem", "linha_id", "valor", F.explode(F.array_compact(F.array(identity, content))).alias("t")).select("t.*", "ordem", "linha_id", "valor")


def _heads(cabeca: Iterable[str], centavos: Iterable[int]) -> list[str]:
    return [f"{h}|{c}|" if h[0] == "=" else f"{h}|" for h, c in zip(cabeca, centavos)]


def _build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    s = Segment.of(_heads(pdf["cabeca"], pdf["centavos"]), pdf["palavras"], pdf["ordem"], pdf["linha_id"], pdf["valor"], pdf["place"])
    return pd.DataFrame([s.row(int(key[0]))])


def search(asked: pd.DataFrame, stored: Segment) -> np.ndarray:
    """Whether each asked text repeats an earlier record of the segment.

    asked: cabeca, centavos, palavras, ordem, linha_id, valor.
    """
    found = np.zeros(len(asked), bool)
    heads = asked["cabeca"].tolist()
    content = np.array([h[0] == "=" for h in heads], bool)
    ordem, linha, valor, cents = (asked[c].to_numpy() for c in ("ordem", "linha_id", "valor", "centavos"))
    cands: dict[int, list[int]] = {}

    def candidates(i: int, lo: int, hi: int) -> None:
        r = stored.owner[lo:hi]
        ok = (stored.ordem[r] < ordem[i]) | (stored.ordem[r] == ordem[i]) & (stored.linha[r] < linha[i])
        if content[i]:
            ok &= np.abs(stored.valor[r] - valor[i]) <= 0.01 + 1e-6
        if ok.any():
            cands.setdefault(i, []).extend(r[ok].tolist())

    los, his = stored.beginning([f"{h}|".encode() for h in heads])
    for i in np.flatnonzero(his > los).tolist():
        if not content[i] or his[i] - los[i] <= 64:
            candidates(i, los[i], his[i])
        else:  # fields with many values: only those a cent apart
            for lo, hi in zip(*stored.beginning([f"{heads[i]}|{cents[i] + step}|".encode() for step in (-1, 0, 1)])):
                candidates(i, lo, hi)
    bodies = asked["palavras"].tolist()
    for i, rs in cands.items():
        if not content[i]:
            found[i] = True
            continue
        body = bodies[i].encode()
        cover = stored.coverage(body, rs)
        mine = sum(map(len, body.split()))
        for r in sorted(rs, key=lambda r: (-cover[r], stored.ordem[r], stored.linha[r])):
            other = stored.body(r)
            most = max(mine, sum(map(len, other.split())))
            if (cover[r] >= ALIKE * most if most else True) or alike(body.decode().split(), other.decode().split()) >= ALIKE:
                found[i] = True
                break
    return found


def _search(asked: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
    if not len(asked) or not len(blobs):
        return asked.iloc[:0][["cabeca", "centavos", "palavras"]]
    found = np.zeros(len(asked), bool)
    for _, row in blobs.iterrows():
        found |= search(asked, Segment.read(row))
    return asked.loc[found, ["cabeca", "centavos", "palavras"]]


def _merge(shards: int, step: int):
    """Joins the shards of two segments whose numbers agree modulo ``step`` and cuts them into ``shards``."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        whole = [Segment.read(r) for _, r in pdf.iterrows()]
        out = []
        for new in range(int(key[0]), shards, step):
            parts = [p for s in whole if (keep := s.place % shards == new).any() for p in [s.part(keep)]]
            while len(parts) > 1:
                parts = [parts[i].merged(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
            out += [p.row(new) for p in parts]
        return pd.DataFrame(out, columns=["shard", *Segment.FIELDS])

    return run


class History:
    """Everything accepted so far, as immutable segments below ``path`` (a folder that all executors reach).

    ``_segments.json`` names the segments that count; it is moved into place in one step after a segment is complete, so
    a run that fails leaves the history as it was. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, shard_rows: int = SHARD_ROWS):
        self.spark, self.path, self.shard_rows = spark, path.rstrip("/"), shard_rows

    def segments(self) -> list[dict]:
        """name, rows and shards of each segment, oldest first."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_segments.json")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        stream = fs.open(p)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _commit(self, segments: list[dict]) -> None:
        tmp = f"{self.path}/_{uuid.uuid4().hex}.json"
        p = self.spark._jvm.org.apache.hadoop.fs.Path(tmp)
        out = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(p, True)
        out.write(bytearray(json.dumps(segments).encode()))
        out.close()
        swap_into_place(self.spark, tmp, f"{self.path}/_segments.json")

    def _read(self, s: dict) -> DataFrame:
        return self.spark.read.schema(Segment.SCHEMA).parquet(f"{self.path}/{s['name']}/shards")

    def _bases(self, s: dict) -> DataFrame:
        """(base, n): the leading fields and blocks of a segment, as hashes, and how many of its texts have them."""
        return self.spark.read.schema("base bigint, n bigint").parquet(f"{self.path}/{s['name']}/bases")

    def _hot(self, s: dict) -> DataFrame | None:
        return self.spark.read.schema("base bigint, pieces int").parquet(f"{self.path}/{s['name']}/hot") if s["hot"] else None

    def _placed(self, texts: DataFrame, s: dict, hot: DataFrame | None, every: bool) -> DataFrame:
        """Texts (with base: the hash of leading fields and block) with the place they are stored at, or all they may be at."""
        if hot is None:
            return texts.withColumn("place", F.col("base"))
        t = texts.join(hot, "base", "left")
        piece = F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)) if every else F.pmod(F.xxhash64("palavras", "centavos"), F.coalesce("pieces", F.lit(1))).cast("int")
        return t.withColumn("piece", piece).withColumn("place", F.when(F.col("piece") > 0, F.col("base").bitwiseXOR(F.xxhash64("piece"))).otherwise(F.col("base"))).drop("pieces", "piece")

    def merge(self) -> None:
        """Merge the last segments while the newer one has grown to the size of the one before."""
        segs = self.segments()
        while len(segs) > 1 and segs[-1]["rows"] >= segs[-2]["rows"]:
            a, b = segs[-2:]
            rows = a["rows"] + b["rows"]
            new = {"name": f"s-{uuid.uuid4().hex}", "rows": rows, "shards": self._shards(rows), "hot": a["hot"] or b["hot"]}
            step = min(a["shards"], b["shards"], new["shards"])
            both = self._read(a).unionByName(self._read(b)).withColumn("__g", F.pmod("shard", F.lit(step)))
            both.groupBy("__g").applyInPandas(_merge(new["shards"], step), Segment.SCHEMA).write.parquet(f"{self.path}/{new['name']}/shards")
            self._bases(a).unionByName(self._bases(b)).groupBy("base").agg(F.sum("n").alias("n")).write.parquet(f"{self.path}/{new['name']}/bases")
            if new["hot"]:
                hot = [h for h in (self._hot(a), self._hot(b)) if h is not None]
                (hot[0] if len(hot) == 1 else hot[0].unionByName(hot[1])).groupBy("base").agg(F.max("pieces").alias("pieces")).write.parquet(f"{self.path}/{new['name']}/hot")
            segs = [*segs[:-2], new]
            self._commit(segs)
            for old in (a, b):
                p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{old['name']}")
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def _shards(self, rows: int) -> int:
        return 1 << max(0, (-(-rows // self.shard_rows) - 1).bit_length())

    def accept(self, rows: DataFrame, loads: DataFrame) -> DataFrame:
        """(linha_id): rows of a new batch that repeat an accepted row or an earlier one of the batch; appends the batch.

        rows: commitments as received; loads: the register of loads. Only segments are read of what was accepted before.
        Taking a batch again finds what it found before and changes no later answer.
        """
        return self.take(written(prepared(rows.filter("linha_id is not null"), loads), "increments"))

    def take(self, p: DataFrame) -> DataFrame:
        """``accept`` for a batch that ``prepared`` has made."""
        self.merge()
        block = F.shiftright("centavos", BLOCK_BITS)
        e = written(entries(p).withColumn("base", F.xxhash64("cabeca", block)), "increment-texts")
        n = e.count()
        none = self.spark.createDataFrame([], p.select("linha_id").schema)
        if not n:
            return none
        new = {"name": f"s-{uuid.uuid4().hex}", "rows": n, "shards": self._shards(n), "hot": False}
        e.groupBy("base").agg(F.count("*").alias("n")).write.parquet(f"{self.path}/{new['name']}/bases")
        half = max(1, self.shard_rows // 2)
        if n > half:
            many = self._bases(new).filter(F.col("n") > half)  # at most 2 n / shard_rows of them
            new["hot"] = not many.isEmpty()
            if new["hot"]:
                many.select("base", F.ceil(F.col("n") / half).cast("int").alias("pieces")).write.parquet(f"{self.path}/{new['name']}/hot")
        stored = self._placed(e, new, self._hot(new), every=False)
        stored.withColumn("shard", F.pmod("place", F.lit(new["shards"])).cast("int")).groupBy("shard").applyInPandas(_build, Segment.SCHEMA).write.parquet(f"{self.path}/{new['name']}/shards")
        segs = [*self.segments(), new]
        # a value at the edge of a block is sought in the next one too
        near = F.array_distinct(F.transform(F.array(*[F.lit(i).cast("bigint") for i in (-1, 0, 1)]), lambda i: F.shiftright(F.col("centavos") + i, BLOCK_BITS)))
        blocks = F.when(F.col("cabeca").startswith("="), near).otherwise(F.array(block))
        asked = e.drop("base", "n").withColumn("__b", F.explode(blocks)).withColumn("__mine", F.col("__b") == block).withColumn("base", F.xxhash64("cabeca", "__b")).drop("__b")
        # a text whose leading fields stand nowhere else can't be a repetition; the others are sought
        known = None
        for s in segs:
            known = self._bases(s) if known is None else known.unionByName(self._bases(s))
        known = known.groupBy("base").agg(F.sum("n").alias("__n"))
        asked = written(asked.join(known, "base").filter(F.col("__n") > F.col("__mine").cast("int")).drop("__n", "__mine"), "increment-asked")
        left = right = None
        for i, s in enumerate(segs):
            q = self._placed(asked, s, self._hot(s), every=True).select(F.lit(i).alias("segment"), F.pmod("place", F.lit(s["shards"])).cast("int").alias("shard"), "cabeca", "centavos", "palavras", "ordem", "linha_id", "valor")
            b = self._read(s).withColumn("segment", F.lit(i))
            left, right = (q, b) if left is None else (left.unionByName(q), right.unionByName(b))
        right = right.join(F.broadcast(left.select("segment", "shard").distinct()), ["segment", "shard"])  # shards that are asked; a row for each shard at most
        hits = left.groupBy("segment", "shard").cogroup(right.groupBy("segment", "shard")).applyInPandas(_search, "cabeca string, centavos bigint, palavras string")
        seen = written(hits, "increment-hits").distinct().withColumn("visto", F.lit(True))
        on = ["cabeca", "centavos", "palavras"]
        groups = e.join(seen, on, "left").withColumn("visto", F.coalesce("visto", F.lit(False))).filter("visto or n > 1")
        groups = groups.select(*on, "visto", F.struct("ordem", "linha_id").alias("__first"), "n")
        out = matching_groups(texts(p).drop("valor"), groups, on, "n").filter(F.col("visto") | (F.col("__first") < F.struct("ordem", "linha_id"))).select("linha_id").distinct()
        out = written(out, "increment-found")
        self._commit(segs)
        return out


def repeated(rows: DataFrame, loads: DataFrame, shard_rows: int = SHARD_ROWS, batches: int = BATCHES) -> DataFrame:
    """(linha_id): rows that are the same commitment as an earlier row of any load, each once.

    Order: day of the load, carga_id, linha_id. The same commitment: equal ano and id (as whole number); or equal
    codigoug, codigocredor, codprocesso (all known), day and valor (known, up to a cent), with a description that was
    only typed otherwise and holds the same numbers. The whole history goes through ``History``, in ``batches`` runs of
    whole loads; the result doesn't depend on the cuts. Two missing descriptions agree. Rows with a null linha_id are
    left out; of rows that share a linha_id within a load none is later. Empty tables give no rows.
    """
    spark = rows.sparkSession
    p = prepared(rows.filter("linha_id is not null"), loads)
    p = written(p, "increments")
    cuts = sorted(set(p.approxQuantile("ordem", [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    path = f"{shared_dir(spark)}/increments-{uuid.uuid4().hex}"
    drop_on_exit(spark, path)  # a query's history isn't kept
    history, out = History(spark, path, shard_rows), None
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        b = p if lo is None else p.filter(F.col("ordem") > F.lit(int(lo)))
        found = history.take(b if hi is None else b.filter(F.col("ordem") <= F.lit(int(hi))))
        out = found if out is None else out.unionByName(found)
    return out
