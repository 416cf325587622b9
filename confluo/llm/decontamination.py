"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Texts are compared in lower case with each run of white space as one space. An item of m characters
occurs in a document if some stretch of it lies within e = floor(m * EDIT_PERCENT / 100) character edits.
By the lemma such a stretch shares at least m + 1 - q (e + 1) of
the item's q-grams on e + 1 neighbouring diagonals, so with bands of 2 (e + 1) diagonals that overlap by
half, one band holds them all. Characters are folded to a byte each and a q-gram is one 64-bit word: a
bit table finds the places of a batch that may hold an item's q-gram, a sorted list confirms them, hits
are counted by item and band, and bands that meet the bound are verified by alignment within the band.
Items for which the bound would be void at q have grams of m // (e + 1) characters.

The items are broadcast if they hold at most BLOCK_BYTES bytes; a larger benchmark is taken in blocks of
about that size, each against all documents. Null and blank items match nothing; repeated items and
items with the same id count alike. Null texts have no regions. Nulls in other columns pass through.
Texts of any length are searched STEP characters at a time, whole; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm.common import documents, map_arrow

Q, EDIT_PERCENT, BLOCK_BYTES, STEP = 8, 10, 8 << 20, 1 << 22
_BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def folded(text: str) -> bytes:
    """A byte for each character; Latin-1 is kept, others share bytes (which only adds candidates)."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return (c ^ c >> np.uint32(8) ^ c >> np.uint32(16)).astype(np.uint8).tobytes()


def grams(raw: bytes, q: int) -> np.ndarray:
    """The q-gram at each place, as a 64-bit word; the last q - 1 places are cut by zero padding."""
    padded = raw + bytes(8)
    words = np.ndarray((len(raw),), "<u8", padded, strides=(1,))
    return words & np.uint64((1 << (8 * q)) - 1)


class Grams:
    """The q-grams of some items, ready for search."""

    def __init__(self, q: int, items: np.ndarray, texts: list[str], edits: np.ndarray):
        self.q, self.edits = q, edits
        gram = [grams(folded(texts[j]), q)[: len(texts[j]) - q + 1] for j in items.tolist()]
        self.need = np.zeros(len(edits), np.int64)
        self.need[items] = [len(g) - q * e for g, e in zip(gram, edits[items].tolist())]
        item = np.repeat(items, [len(g) for g in gram])
        at = np.concatenate([np.arange(len(g)) for g in gram])
        gram = np.concatenate(gram)
        order = np.argsort(gram, kind="stable")
        self.item, self.at = item[order], at[order]
        self.keys, self.first, self.many = np.unique(gram[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _BITS, bool)
        self.table[self.keys * _ODD >> np.uint64(64 - _BITS)] = True
        #: Diagonals start below zero by at most an item's length and edits: this much makes them positive.
        self.shift = int(max(len(t) for t in texts) + 2 * edits.max()) + 2

    def hits(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The places in raw where a q-gram of an item begins, and its key's number."""
        out = []
        for a in range(0, len(raw), STEP):
            words = grams(raw[a : a + STEP + 8], self.q)[:STEP]
            place = np.flatnonzero(self.table[words * _ODD >> np.uint64(64 - _BITS)])
            k = np.searchsorted(self.keys, words[place])
            k[k == len(self.keys)] = 0
            real = self.keys[k] == words[place]
            out.append((place[real] + a, k[real]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2

    def bands(self, raw: bytes, starts: np.ndarray):
        """(document, item, first diagonal of the band in the document) of each band with enough hits, taken in blocks of documents."""
        place, key = self.hits(raw)
        many = self.many[key]
        cuts = np.searchsorted(np.cumsum(many), np.arange(0, int(many.sum()) + 1, 4_000_000), "left")
        doc_of = np.searchsorted(starts, place, "right") - 1
        # A block ends where a document does, so that no band is counted in two parts.
        edges = sorted({0, len(place), *(int(np.searchsorted(doc_of, doc_of[c], "left")) for c in cuts if 0 < c < len(place))})
        for a, b in zip(edges, edges[1:]):
            n = many[a:b]
            row = np.repeat(np.arange(a, b), n)
            posting = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[key[a:b]], n)
            item, doc = self.item[posting], doc_of[row]
            width = self.edits[item] + 1
            band = (place[row] - starts[doc] - self.at[posting] + self.shift) // width
            short = len(self.need) < 1 << 20 and band.max(initial=0) < 1 << 23 and doc.max(initial=0) < 1 << 19
            code = (doc << 44) + (item << 24) + band if short else None
            both = np.concatenate([code, code - 1]) if short else np.concatenate([np.stack([doc, item, band], 1), np.stack([doc, item, band - 1], 1)])
            found, times = np.unique(both, axis=None if short else 0, return_counts=True)
            doc, item, band = (found >> 44, found >> 24 & 0xFFFFF, found & 0xFFFFFF) if short else found.T
            ok = times >= self.need[item]
            if short:
                ok &= band < 1 << 23
            for d, j, k in zip(doc[ok].tolist(), item[ok].tolist(), band[ok].tolist()):
                yield d, j, k * (int(self.edits[j]) + 1) - self.shift


class Benchmark:
    """Items made ready for search."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, edit_percent: int = EDIT_PERCENT):
        if not 1 <= q <= 8 or not 0 <= edit_percent < 100:
            raise ValueError("q must be 1 to 8, edit_percent 0 to 99")
        self.ids, self.texts = [], []
        for i, t in items:
            if t and (t := normal(t)):
                self.ids.append(i)
                self.texts.append(t)
        self.m = np.array([len(t) for t in self.texts], np.int64)
        self.edits = self.m * edit_percent // 100
        # The lemma must ask for one shared q-gram or more: short items have shorter grams.
        own = np.minimum(q, self.m // (self.edits + 1))
        self.groups = [Grams(k, np.flatnonzero(own == k), self.texts, self.edits) for k in np.unique(own).tolist()]

    def regions(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each text: (item's place, first, end, edits) of the best stretch of every item that occurs in it, in the normal form."""
        texts = [normal(t) for t in texts]
        out: list[dict] = [{} for _ in texts]
        parts = [folded(t) + bytes(8) for t in texts]  # a gram of two texts holds zeros between
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        raw = b"".join(parts)
        for group in self.groups:
            for doc, item, band in group.bands(raw, starts):
                self._verify(texts[doc], item, band, out[doc])
        return [sorted(x.values()) for x in out]

    def _verify(self, text: str, j: int, diagonal: int, out: dict) -> None:
        if out.get(j, (0, 0, 0, 1))[3] == 0:
            return
        item, e = self.texts[j], int(self.edits[j])
        low, high = max(0, diagonal - e), min(len(text), diagonal + 2 * (e + 1) + len(item) + e)
        if (p := text.find(item, low, high)) >= 0:
            out[j] = (j, p, p + len(item), 0)
        elif e and (hit := banded(item, text, diagonal - e, diagonal + 2 * (e + 1) + e, e)):
            if j not in out or hit[2] < out[j][3]:
                out[j] = (j, *hit)


def _codes(t: str) -> np.ndarray:
    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)


def banded(item: str, text: str, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(first, end, edits) of a stretch of text nearest to item among alignments on the diagonals low to high - 1, if within most edits."""
    a, width = _codes(item), high - low
    # Diagonals outside the text meet a code that no character has.
    left, size = max(0, -low), len(a) + width
    body = _codes(text[max(0, low) : max(0, low + size)])
    b = np.full(left + len(body) + size, 0xFFFFFFFF, np.uint32)
    b[left : left + len(body)] = body
    steps, far, unit = np.arange(width), 1 << 30, 1 << width.bit_length()
    cost, origin = np.zeros(width, np.int64), np.arange(width)
    outside = (steps + low < 0) | (steps + low > len(text))
    cost[outside] = far
    for i, c in enumerate(a.tolist()):
        # Cost and start, below unit, travel together: among equal costs the later start wins.
        keep = (cost + (b[i : i + width] != c)) * unit - origin
        skip = np.full(width, far * unit)
        skip[:-1] = (cost[1:] + 1) * unit - origin[1:]
        best = np.minimum(keep, skip) - steps * unit
        best = np.minimum.accumulate(best) + steps * unit
        cost = -(-best // unit)
        origin = cost * unit - best
        if cost.min() > most:
            return None
    ends = steps + low + len(a)
    cost[ends > len(text)] = far
    k = int(cost.argmin())
    return (int(origin[k]) + low, int(ends[k]), int(cost[k])) if cost[k] <= most else None


def _blocks(items: DataFrame, block_bytes: int):
    """The items, in lists of about block_bytes bytes at most; one list comes to the driver at a time."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-total // block_bytes) or 1
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r.item_id, r.text) for r in part.collect()]


def contaminated_regions(docs: DataFrame, items: DataFrame, q: int = Q, edit_percent: int = EDIT_PERCENT, block_bytes: int = BLOCK_BYTES, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, extra columns, and regions (item_id, first, end, edits; the best of each item) of each row of docs."""
    kinds = dict(docs.dtypes)
    form = "array<struct<item_id:bigint,first:int,end:int,edits:int>>"
    names = ["doc_id", *extra]

    def search(frame: DataFrame, own: list, last: str | None) -> DataFrame:
        shared = frame.sparkSession.sparkContext.broadcast(own)
        ready: dict = {}

        def work(batch):
            if "b" not in ready:
                ready["b"] = Benchmark(shared.value, q, edit_percent)
            b = ready["b"]
            found = [[{"item_id": b.ids[j], "first": f, "end": e, "edits": d} for j, f, e, d in r] for r in b.regions(batch.column("text").to_pylist())]
            if last:
                found = [x + y for x, y in zip(batch.column(last).to_pylist(), found)]
            yield {c: batch.column(c) for c in [*names, "text"]} | {"regions": found}

        return map_arrow(frame, work, ", ".join(f"`{c}` {kinds[c]}" for c in names) + f", text string, regions {form}")

    out, last = docs.select(*names, F.coalesce("text", F.lit("")).alias("text")), None
    for own in _blocks(items, block_bytes):
        out, last = search(out, own, last), "regions"
    return out.select(*names, "regions")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs without a region, with docs' columns."""
    names = docs.columns
    packed = docs.select("doc_id", "text", F.struct(*[docs[c] for c in names]).alias("_row"))
    kinds = dict(packed.dtypes)
    found = contaminated_regions(packed, items, extra=("_row",)) if kinds else packed
    return found.where(F.size("regions") == 0).select("_row.*")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (ascending), least_edits for every document."""
    found = contaminated_regions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.array_distinct(F.transform("regions", lambda r: r["item_id"])))
    return found.select("doc_id", (F.size("regions") > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), F.array_min(F.transform("regions", lambda r: r["edits"])).alias("least_edits"))
