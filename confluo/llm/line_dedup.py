"""Near-equal lines by an exact set-similarity join; later matches are removed.

A line (split at \\n) is the set of its words (runs outside ASCII white space, unchanged). Lines without
words are left alone. A line goes if a line before it, in the order of (doc_id, line number, hash of the
set, hash of the text), has Jaccard similarity PERCENT / 100 or more with it, whether or not that one stays itself.
Rows come in any order. Null doc_ids come last. Rows equal in id and text are one document; rows that
share an id alone are documents of their own. An empty table gives an empty result.

Words are ordered by rarity: by the coded count of their bucket among 2^BUCKETS counts over
the whole corpus (a broadcast of 16 MB at any size; any order gives the same result), then by hash. With t = PERCENT / 100, a set of
n words probes with its n - ceil(t n) + 1 rarest and is met, by sets at least as large, at its
n - ceil(2 t n / (1 + t)) + 1 rarest. A word whose bucket counts once meets nothing and is left out.
Equal sets are one class. In the postings of a word, sorted by size, the length filter is a range; pairs
then pass the positional bound on the overlap and a bound from 64- or 128-bit parity maps, whose differing bits
cannot outnumber the sets' differing words. All three are exact: they drop no pair that matches.

Postings travel as packed columns: a task holds up to FLUSH of them and sends each bucket of words one
block, so Spark moves a few thousand rows and the filters run on arrays. A word with over HOT postings is not
paired in the task that gathers it: its postings are dealt out again in blocks that meet two by two, so
what a task holds is bounded whatever a word's share.

A class needs one earlier match only, so pairs in a group of copies are never all made: of a probe's
candidates under a word the KEEP that look most alike go on, with a mark where there were more. First the
most alike candidate of every class is verified on full sets, then all others of the classes still undecided; those
that use up their candidates and bear the mark are probed again against everything. Their words reach that
second scan as a bitmap of a fixed size, which lets more lines through but loses none. Words and sets
are compared by 64-bit hashes (a word in a posting by 42 bits, which adds candidates only).
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm.common import MULT, bitmap, documents, drop, free_shuffles, is_marked, map_arrow, mixed, small_batches, span_hashes, utf8, word_spans, written

PERCENT, BUCKETS, SLICES, KEEP = 75, 24, 64, 8
FLUSH, PER_BUCKET, HOT = 1 << 18, 1 << 16, 1 << 16
#: Sets above this size carry a map of 128 bits, others one of 64.
WIDE = 60
BLOCK = 500_000
LAST = (1 << 63) - 1


def _ordered(line: np.ndarray, key: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The order by (line, key), ties as they come: one sort of packed keys, with the places in their last bits if the rest tells the words apart, or a full one where packing makes different words equal."""
    bits = int(line.max()).bit_length() if len(line) else 0
    if key is words and 0 < bits and bits + (low := len(line).bit_length()) <= 40:
        # Values sort several times faster than places do.
        packed = np.sort(line.astype(np.uint64) << np.uint64(64 - bits) | key >> np.uint64(bits + low) << np.uint64(low) | np.arange(len(line), dtype=np.uint64))
        order = (packed & np.uint64((1 << low) - 1)).astype(np.int64)
        packed >>= np.uint64(low)
        if not ((packed[1:] == packed[:-1]) & (words[order[1:]] != words[order[:-1]])).any():
            return order
    packed = line.astype(np.uint64) << np.uint64(64 - bits) | key >> np.uint64(bits) if bits else key
    order = np.argsort(packed)
    packed, words = packed[order], words[order]
    if ((packed[1:] == packed[:-1]) & (words[1:] != words[:-1])).any():
        return np.lexsort((words, key, line))
    return order


class Lines:
    """The lines with words of a batch of texts, as flat arrays; each line's words are distinct and in the order of their hashes."""

    def __init__(self, texts: list[bytes]):
        raw = b"\n".join(texts)
        buffer = np.frombuffer(raw, np.uint8)
        start, end = word_spans(buffer)
        breaks = np.flatnonzero(buffer == 10)
        heads = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        # Words before each break and after the last; the break that ends a text is a break too.
        before = np.diff(np.concatenate([[0], np.searchsorted(start, breaks), [len(start)]]))
        at = np.flatnonzero(before)
        line = np.repeat(np.arange(len(at)), before[at])
        self.doc = np.searchsorted(heads, np.concatenate([[-1], breaks])[at] + 1, "right") - 1
        self.number = at - np.searchsorted(breaks, heads)[self.doc]
        words = span_hashes(raw, start, end)
        order = _ordered(line, words, words)
        words, line = words[order], line[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
        self.words, self.line = words[new], line[new]
        self.n = np.bincount(self.line, minlength=len(at))
        self.start = np.cumsum(self.n) - self.n
        self.set = mixed(self._over(np.add, mixed(self.words)) ^ self.n.astype(np.uint64)).view(np.int64)

    @classmethod
    def known(cls, sets: np.ndarray, words: list[bytes], number: np.ndarray) -> Lines:
        """Lines of given words, one a document."""
        own = cls.__new__(cls)
        own.set, own.number, own.doc, own.words = sets, number, np.arange(len(sets)), np.frombuffer(b"".join(words), np.uint64)
        own.n = np.fromiter((len(w) >> 3 for w in words), np.int64, len(words))
        own.start, own.line = np.cumsum(own.n) - own.n, np.repeat(np.arange(len(words)), own.n)
        return own

    def packed_words(self, at: np.ndarray) -> list[bytes]:
        return [self.words[a:b].tobytes() for a, b in zip(self.start[at].tolist(), (self.start + self.n)[at].tolist())]

    def _over(self, f, x: np.ndarray) -> np.ndarray:
        return f.reduceat(x, self.start) if len(self.start) else np.zeros(0, np.uint64)

    def parities(self) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit parity map of each line's words, and the part of it that odd hashes make: the two give a map of 128 bits."""
        bit = np.uint64(1) << (self.words >> np.uint64(1) & np.uint64(63))
        return self._over(np.bitwise_xor, bit), self._over(np.bitwise_xor, np.where(self.words & np.uint64(1) != 0, bit, np.uint64(0)))

    def prefixes(self, counts: np.ndarray, percent: int, ids: np.ndarray):
        """word, line, place of the words that probe, for the first line of each set."""
        own = first_of(self.set, ids[self.doc], self.number)
        mine = np.zeros(len(self.n), bool)
        mine[own] = True
        words, line, place = probing(self.words[mine[self.line]], self.n[mine], counts, percent)
        return words, np.flatnonzero(mine)[line], place


def first_of(sets: np.ndarray, doc: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The place of each set's first line in the order of (doc, number); rows come in any order."""
    order = np.lexsort((number, doc, sets))
    return order[np.unique(sets[order], return_index=True)[1]]


def not_first(x: np.ndarray) -> np.ndarray:
    """Which of some lines (LINE) have an equal set before them; lines of repeated rows share their place."""
    order = np.lexsort((x["mark"], x["number"], x["doc"], x["set"]))
    x = x[order]
    head = np.flatnonzero(np.diff(x["set"], prepend=x["set"][:1] - 1) != 0)
    first = x[np.repeat(head, np.diff(head, append=len(x)))]
    out = np.empty(len(x), bool)
    out[order] = (x["doc"] != first["doc"]) | (x["number"] != first["number"]) | (x["mark"] != first["mark"])
    return out


def probing(words: np.ndarray, sizes: np.ndarray, counts: np.ndarray, percent: int):
    """word, line, place of the rarest words of lines given as flat words and sizes: by their bucket's count, then by hash."""
    line = np.repeat(np.arange(len(sizes)), sizes)
    often = counts[words >> np.uint64(64 - BUCKETS)].astype(np.uint64)
    order = _ordered(line, often << np.uint64(56) | words >> np.uint64(8), words)
    place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    use = (place < (sizes - _ceil(percent * sizes, 100) + 1)[line]) & (often[order] > 1)
    return words[order][use], line[use], place[use]


def _ceil(a, b):
    return -(-a // b)


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes that rise with them: as they are below 32, then eight steps for each doubling."""
    steps = 32 + np.floor(8 * np.log2(np.maximum(counts, 32) / 32)).astype(np.int64)
    return np.where(counts < 32, counts, np.minimum(steps, 255)).astype(np.uint8)


#: A line as it is kept: late marks one that goes whatever its set's fate.
LINE = np.dtype([("set", "<i8"), ("doc", "<i8"), ("mark", "<i8"), ("number", "<i4"), ("late", "?")])


def scanned(rows: DataFrame, flush: int) -> tuple[DataFrame, np.ndarray, int]:
    """block: all lines with words, up to about flush in a block; the words' bucket counts; the number of words."""

    def work(batches):
        import pyarrow as pa

        form = pa.schema([("slice", pa.int32()), ("block", pa.binary())])
        at_bucket, counts, waiting, held, lines = np.zeros(0, np.uint32), np.zeros(0, np.int64), [], 0, []

        def summed():
            """The buckets met and their counts: those waiting by one sort, then added to the earlier."""
            new = np.sort(np.concatenate([np.zeros(0, np.uint32), *waiting]))
            head = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1]])) if len(new) else np.zeros(0, np.int64)
            at, n = new[head], np.diff(head, append=len(new))
            if not len(at_bucket):
                return at, n
            at, back = np.unique(np.concatenate([at_bucket, at]), return_inverse=True)
            return at, np.bincount(back, np.concatenate([counts, n]), len(at)).astype(np.int64)

        def kept():
            """The lines held: all but the first of each set go, and are marked."""
            x = np.concatenate(lines)
            x["late"] = not_first(x)
            return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.array([x.tobytes()], pa.binary())], schema=form)

        for batch in batches:
            own = Lines(batch.column("text").to_pylist())
            waiting.append((own.words >> np.uint64(64 - BUCKETS)).astype(np.uint32))
            held += len(waiting[-1])
            if held > 1 << 23:
                (at_bucket, counts), waiting, held = summed(), [], 0
            x = np.empty(len(own.n), LINE)
            x["set"], x["number"] = own.set, own.number
            x["doc"], x["mark"] = (batch.column(k).to_numpy()[own.doc] for k in ("doc", "mark"))
            lines.append(x)
            if sum(map(len, lines)) >= flush:
                yield kept()
                lines = []
        if lines:
            yield kept()
        at_bucket, counts = summed()
        cuts = np.searchsorted(at_bucket, np.arange(1, SLICES) << (BUCKETS - 6))
        pairs = np.stack([at_bucket, np.minimum(counts, 0xFFFFFFFF)]).astype("<u4")
        parts = [x.tobytes() for x in np.split(pairs, cuts, axis=1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], schema=form)

    def total(batches):
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, raw in zip(batch.column("slice").to_pylist(), batch.column("block").to_pylist()):
                at, n = np.frombuffer(raw, "<u4").reshape(2, -1)
                own = sums.setdefault(s, np.zeros((1 << BUCKETS) // SLICES, np.uint64))
                own[at & np.uint32(len(own) - 1)] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([coded(x).tobytes() for x in sums.values()], pa.binary()), pa.array([int(x.sum()) for x in sums.values()], pa.int64())], ["slice", "counts", "n"])

    small_batches(rows.sparkSession)
    table = written(rows.mapInArrow(work, "slice int, block binary"), "lines")
    # SLICES rows of a fixed size come to the driver.
    sums = table.where("slice IS NOT NULL").repartition("slice").mapInArrow(total, "slice int, counts binary, n long").collect()
    counts = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in sorted(sums)]) if sums else np.zeros(1 << BUCKETS, np.uint8)
    return table.where("slice IS NULL").select("block"), counts, sum(r["n"] for r in sums)


def _gone(lines: DataFrame, late: DataFrame, buckets: int) -> DataFrame:
    """doc, mark, number of the lines that go: of each set all but the first, or all if the set is in late (set)."""

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            for block in batch.column("block").to_pylist():
                x = np.frombuffer(block, LINE)
                # What goes anyway is spread by document.
                bucket = np.where(x["late"], mixed(x["doc"].astype(np.uint64)).view(np.int64), x["set"]) & (buckets - 1)
                order = np.argsort(bucket, kind="stable")
                x, bucket = x[order], bucket[order]
                cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(x)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()), pa.nulls(len(cuts) - 1, pa.int64())], ["bucket", "block", "set"])

    def scan(batches):
        import pyarrow as pa

        def finish():
            x = np.concatenate([np.frombuffer(b, LINE) for b in blocks]) if blocks else np.zeros(0, LINE)
            own = np.flatnonzero(~x["late"])
            gone = x["late"] | np.isin(x["set"], np.array(sets, np.int64))
            gone[own[not_first(x[own])]] = True
            x = x[gone]
            return pa.RecordBatch.from_arrays([pa.array(x[k]) for k in ("doc", "mark", "number")], ["doc", "mark", "number"])

        last, blocks, sets = None, [], []
        for batch in batches:
            for bucket, block, one in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist(), batch.column("set").to_pylist()):
                if bucket != last and last is not None:
                    yield finish()
                    blocks, sets = [], []
                last = bucket
                blocks.append(block) if block is not None else sets.append(one)
        if last is not None:
            yield finish()

    late = late.select(F.col("set").bitwiseAND(F.lit(buckets - 1)).alias("bucket"), F.lit(None).cast("binary").alias("block"), "set")
    dealt = lines.mapInArrow(deal, "bucket long, block binary, set long").unionByName(late)
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(scan, "doc long, mark long, number int")


_HEAD = struct.Struct("<Iq5B")
_WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in as few bytes as hold them all."""
    top = int(x.max(initial=0))
    return x.astype(_WIDTHS[1 << (top > 0xFF) + (top > 0xFFFF) + (top > 0xFFFFFFFF)])


def packed(columns: dict[str, np.ndarray], cuts: np.ndarray) -> list[bytes]:
    """Blocks of postings, cut at cuts: word, set, fold, n, place, doc, number, asked, and high where n is above WIDE."""
    base = columns["doc"].min(initial=LAST)
    small = [_narrow(x) for x in (columns["n"], columns["place"], (columns["doc"].view(np.uint64) - base.view(np.uint64)), columns["number"])]
    asked = columns.get("asked")
    parts = [columns["word"], columns["set"], columns["fold"], *small, *([asked] if asked is not None else [])]
    high, wide = columns["high"], columns["n"] > WIDE
    sizes = [x.itemsize for x in small] + [asked is not None]
    return [b"".join([_HEAD.pack(b - a, int(base), *sizes), *(x[a:b].tobytes() for x in parts), high[a:b][wide[a:b]].tobytes()]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def unpacked(block: bytes) -> dict[str, np.ndarray]:
    count, base, *sizes, asked = _HEAD.unpack_from(block)
    at, out = _HEAD.size, {}

    def take(kind, n=count):
        nonlocal at
        at += (size := n * np.dtype(kind).itemsize)
        return np.frombuffer(block, kind, n, at - size)

    out["word"], out["set"], out["fold"] = take(np.uint32), take(np.int64), take(np.uint64)
    n, place, doc, number = (take(_WIDTHS[s]) for s in sizes)
    out |= {"n": n.astype(np.int64), "place": place.astype(np.int64), "doc": (doc.astype(np.uint64) + np.int64(base).view(np.uint64)).view(np.int64), "number": number.astype(np.int64)}
    out["asked"] = take(bool) if asked else np.zeros(count, bool)
    out["high"] = np.zeros(count, np.uint64)
    out["high"][out["n"] > WIDE] = take(np.uint64, int((out["n"] > WIDE).sum()))
    return out


def _joined(blocks: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return blocks[0] if len(blocks) == 1 else {k: np.concatenate([b[k] for b in blocks]) for k in blocks[0]}


def _picked(x: dict[str, np.ndarray], at) -> dict[str, np.ndarray]:
    return {k: v[at] for k, v in x.items()}


def postings(rows: DataFrame, lines_of, shared, percent: int, buckets: int, flush: int, asked=None) -> DataFrame:
    """bucket, n, block: the probing words of each task's distinct lines; lines_of a batch of rows gives its Lines. With asked, a bitmap of sets, the lines of those sets are marked."""

    def work(batches):
        import pyarrow as pa

        def dealt():
            line = {k: np.concatenate([x[k] for x in lines]) for k in lines[0]}
            word, at, place = (np.concatenate(x) for x in zip(*posts))
            keep = np.zeros(len(line["set"]), bool)
            keep[first_of(line["set"], line["doc"], line["number"])] = True
            use = np.flatnonzero(keep[at])
            bucket = (word[use] & np.uint64(buckets - 1)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
            order = np.argsort(bucket, kind="stable")
            use, bucket = use[order], bucket[order].astype(np.int64)
            cuts = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(use)]])
            blocks = packed({k: v[at[use]] for k, v in line.items()} | {"word": (word[use] >> np.uint64(32)).astype(np.uint32), "place": place[use]}, cuts)
            return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), pa.array(np.diff(cuts)), pa.array(blocks, pa.binary())], ["bucket", "n", "block"])

        lines, posts, held, n = [], [], 0, 0
        for batch in batches:
            own, ids = lines_of(batch), batch.column("doc").to_numpy()
            word, at, place = own.prefixes(shared.value, percent, ids)
            fold, high = own.parities()
            lines.append({"set": own.set, "n": own.n, "fold": fold, "high": high, "doc": ids[own.doc], "number": own.number} | ({"asked": is_marked(asked.value, own.set)} if asked else {}))
            posts.append((word, at + n, place))
            n += len(own.n)
            held += len(word)
            if held >= flush:
                yield dealt()
                lines, posts, held, n = [], [], 0, 0
        if held:
            yield dealt()

    small_batches(rows.sparkSession)
    return rows.mapInArrow(work, "bucket long, n long, block binary")


def size_class(n: np.ndarray) -> np.ndarray:
    """Classes that rise with the size."""
    return np.floor(np.log(n) / np.log(4 / 3)).astype(np.int64)


def _keys(words: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return mixed(words + classes.astype(np.uint64) * MULT)


def _asked_keys(sets: DataFrame, shared, percent: int) -> DataFrame:
    """key: the probing words of sets (words) with each class of sizes that a similar set may have."""

    def work(batch):
        raw = batch.column("words").to_pylist()
        n = np.fromiter((len(w) >> 3 for w in raw), np.int64, len(raw))
        word, line, _ = probing(np.frombuffer(b"".join(raw), np.uint64), n, shared.value, percent)
        low, high = size_class(_ceil(percent * n, 100))[line], size_class(100 * n // percent)[line]
        many = high - low + 1
        classes = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        yield {"key": _keys(np.repeat(word, many), classes).view(np.int64)}

    return map_arrow(sets, work, "key long")


def _near(rows: DataFrame, keys) -> DataFrame:
    """set, doc, number, words of the lines that hold a marked word in a marked class of sizes."""

    def work(batch):
        import pyarrow as pa

        own = Lines(batch.column("text").to_pylist())
        hit = np.unique(own.line[is_marked(keys.value, _keys(own.words, size_class(own.n)[own.line]))])
        yield {"set": own.set[hit], "doc": batch.column("doc").take(pa.array(own.doc[hit])), "number": own.number[hit].astype(np.int32), "words": pa.array(own.packed_words(hit), pa.binary())}

    return map_arrow(rows, work, "set long, doc long, number int, words binary")


def _of_texts(batch) -> Lines:
    return Lines(batch.column("text").to_pylist())


def _of_words(batch) -> Lines:
    return Lines.known(batch.column("set").to_numpy(), batch.column("words").to_pylist(), batch.column("number").to_numpy().astype(np.int64))


def _pairs(word, n, place, fold, high, percent):
    """Index pairs (smaller, larger set) that pass the filters and their differing bits, in blocks; arrays are sorted by word and size."""
    group = np.cumsum(np.concatenate([[0], word[1:] != word[:-1]]))
    key = group.astype(np.int64) << 32 | n
    start = np.searchsorted(key, group.astype(np.int64) << 32 | _ceil(percent * n, 100))
    # The smaller sets are met at fewer words: a larger one's candidates are a run of these places.
    met = np.flatnonzero(place < n - _ceil(2 * percent * n, 100 + percent) + 1)
    before = np.searchsorted(met, np.arange(len(n) + 1))
    start = before[start]
    many = before[:-1] - start
    cuts = np.searchsorted(np.cumsum(many), np.arange(BLOCK, int(many.sum()) + BLOCK, BLOCK))
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(n)]])):
        b = min(b, len(n))
        if a >= b:
            continue
        larger = np.repeat(np.arange(a, b), many[a:b])
        smaller = met[np.arange(len(larger)) - np.repeat(np.cumsum(many[a:b]) - many[a:b] - start[a:b], many[a:b])]
        both = n[larger] + n[smaller]
        need = _ceil(percent * both, 100 + percent)
        ok = np.minimum(n[larger] - place[larger], n[smaller] - place[smaller]) >= need
        larger, smaller, both, need = larger[ok], smaller[ok], both[ok], need[ok]
        differ, odd = fold[larger] ^ fold[smaller], high[larger] ^ high[smaller]
        apart = np.where(n[smaller] > WIDE, np.bitwise_count(differ ^ odd).astype(np.int64) + np.bitwise_count(odd), np.bitwise_count(differ))
        ok = apart <= both - 2 * need
        yield smaller[ok], larger[ok], apart[ok]


def _by_word(key: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """The order by (key, set): a plain sort, and a full one of those alone that share a key."""
    order = np.argsort(key)
    key = key[order]
    tie = np.zeros(len(key), bool)
    tie[1:] = key[1:] == key[:-1]
    tie[:-1] |= tie[1:]
    at = np.flatnonzero(tie)
    order[at] = order[at][np.lexsort((sets[order[at]], key[at]))]
    return order


def matched(x: dict[str, np.ndarray], percent: int, keep: int, asked: bool = False, between: bool = False):
    """late, early (sets), alike (per mille), more: the keep candidates of each late posting that look most alike; with asked those of marked sets, with between those across sides."""
    x = _picked(x, _by_word(x["word"].astype(np.int64) << 32 | x["n"], x["set"]))
    new = np.ones(len(x["set"]), bool)
    new[1:] = (x["set"][1:] != x["set"][:-1]) | (x["word"][1:] != x["word"][:-1])
    if not new.all():  # a set comes from several tasks: its first line counts
        several = ~new
        several[:-1] |= ~new[1:]
        at, group, first = np.flatnonzero(several), np.cumsum(new), np.arange(len(new))
        first[at] = at[np.lexsort((x["number"][at], x["doc"][at], group[at]))]
        x = _picked(x, first[new])
    for s, g, apart in _pairs(x["word"], x["n"], x["place"], x["fold"], x["high"], percent):
        if between:
            ok = x["side"][s] != x["side"][g]
            s, g, apart = s[ok], g[ok], apart[ok]
        met, back = np.unique(np.concatenate([s, g]), return_inverse=True)
        rank = np.empty(len(met), np.int64)
        rank[np.lexsort((x["set"][met], x["number"][met], x["doc"][met]))] = np.arange(len(met))
        rank = rank[back]
        later = rank[: len(s)] > rank[len(s) :]
        late, early = np.where(later, s, g), np.where(later, g, s)
        both = x["n"][s] + x["n"][g]
        alike = 1000 * (both - apart) // (both + apart)
        if asked:
            ok = x["asked"][late]
            late, early, alike = late[ok], early[ok], alike[ok]
        if not len(late):
            continue
        order = np.lexsort((x["set"][early], -alike, late))
        late, early, alike = late[order], early[order], alike[order]
        head = np.concatenate([[True], late[1:] != late[:-1]])
        group = np.cumsum(head) - 1
        more = np.bincount(group)[group] > keep if keep else np.zeros(len(late), bool)
        use = np.arange(len(late)) - np.flatnonzero(head)[group] < keep if keep else np.ones(len(late), bool)
        late, early = x["set"][late[use]], x["set"][early[use]]
        alike, more = alike[use], more[use]
        # A pair comes once from each common word: here one row is enough.
        known, back = np.unique(np.concatenate([late, early]), return_inverse=True)
        _, one, back = np.unique(back[: len(late)] * len(known) + back[len(late) :], return_index=True, return_inverse=True)
        yield late[one], early[one], alike[one], np.bincount(back, more, len(one)) > 0


_MADE = "late long, early long, alike int, more boolean, bucket long, block binary"


def _as_rows(found, blocks=()):
    import pyarrow as pa

    form = pa.schema([("late", pa.int64()), ("early", pa.int64()), ("alike", pa.int32()), ("more", pa.bool_()), ("bucket", pa.int64()), ("block", pa.binary())])
    if blocks:
        return pa.RecordBatch.from_arrays([pa.nulls(len(blocks), f.type) for f in list(form)[:4]] + [pa.array([b for b, _ in blocks], pa.int64()), pa.array([x for _, x in blocks], pa.binary())], schema=form)
    late, early, alike, more = found
    return pa.RecordBatch.from_arrays([pa.array(late), pa.array(early), pa.array(alike.astype(np.int32)), pa.array(more), pa.nulls(len(late), pa.int64()), pa.nulls(len(late), pa.binary())], schema=form)


def candidates(posts: DataFrame, percent: int, keep: int, asked: bool = False, hot: int = HOT) -> DataFrame:
    """late, early, alike, more of the candidates in postings (bucket, n, block)."""

    def scan(batches):
        bucket, held, n, limit, over = None, [], 0, 0, np.zeros(0, np.uint32)

        def split():
            """The held postings without those of hot words, and these as a block."""
            nonlocal over
            x = _joined(held)
            word, many = np.unique(x["word"], return_counts=True)
            over = np.union1d(over, word[many > hot])
            if not len(over):
                return x, None
            gone = np.isin(x["word"], over)
            away = _picked(x, gone)
            return _picked(x, ~gone), packed(away, np.array([0, len(away["word"])]))[0] if gone.any() else None

        def finish():
            x, away = split()
            if away:
                yield _as_rows(None, [(bucket, away)])
            if len(x["word"]):
                for found in matched(x, percent, keep, asked):
                    yield _as_rows(found)

        for batch in batches:
            for b, many, block in zip(batch.column("bucket").to_pylist(), batch.column("n").to_pylist(), batch.column("block").to_pylist()):
                if b != bucket:
                    if held:
                        yield from finish()
                    bucket, held, n, limit, over = b, [], 0, 4 * hot, np.zeros(0, np.uint32)
                held.append(unpacked(block))
                n += many
                if n > limit:
                    x, away = split()
                    if away:
                        yield _as_rows(None, [(bucket, away)])
                    held, n = [x], len(x["word"])
                    limit = max(limit, 2 * n)
        if held:
            yield from finish()

    small_batches(posts.sparkSession)
    made = written(posts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(scan, _MADE), "met")
    hot_blocks, columns = made.where("block IS NOT NULL").select("bucket", "block"), ["late", "early", "alike", "more"]
    found = made.where("block IS NULL").select(*columns)
    return found if hot_blocks.isEmpty() else found.unionByName(_hot_candidates(hot_blocks, percent, keep, asked, hot).select(*columns))


def _hot_candidates(blocks: DataFrame, percent: int, keep: int, asked: bool, hot: int) -> DataFrame:
    """The candidates of words with over hot postings: blocks of half as many meet two by two, one pair of them in a task at a time."""
    names = ["bucket", "word", "set", "fold", "high", "n", "place", "doc", "number"]

    def rows_of(batch):
        import pyarrow as pa

        parts = [unpacked(b) for b in batch.column("block").to_pylist()]
        x = _joined(parts)
        yield {k: pa.array((x[k].view(np.int64) if x[k].dtype == np.uint64 else x[k].astype(np.int64))) for k in names[1:]} | {"bucket": batch.column("bucket").take(pa.array(np.repeat(np.arange(len(parts)), [len(p["word"]) for p in parts]))), "asked": pa.array(x["asked"])}

    posts = map_arrow(blocks, rows_of, ", ".join(f"{k} long" for k in names) + ", asked boolean")
    # A set's first line: its other columns are the same wherever it stands.
    posts = posts.groupBy("bucket", "word", "set").agg(F.min(F.struct("doc", "number")).alias("at"), *[F.first(k).alias(k) for k in ("fold", "high", "n", "place", "asked")])
    posts = written(posts.select("bucket", "word", "set", "fold", "high", "n", "place", "asked", "at.*"), "hot")
    parts = posts.groupBy("bucket", "word").agg(F.ceil(2 * F.count("*") / hot).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    jobs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")))
    dealt = posts.join(parts, ["bucket", "word"]).withColumn("own", own).withColumn("job", F.explode(jobs)).select(*names, "asked", "own", "job.*")

    def scan(batches):
        key, held = None, []

        def finish():
            x = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
            x |= {k: x[k].view(np.uint64) for k in ("fold", "high")}
            for found in matched(x, percent, keep, asked, key[2] != key[3]):
                yield _as_rows(found)

        for batch in batches:
            cols = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in (*names, "asked", "own", "i", "j")}
            keys = list(zip(*(cols[k].tolist() for k in ("bucket", "word", "i", "j"))))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if keys[a] != key:
                    if held:
                        yield from finish()
                    key, held = keys[a], []
                held.append({k: cols[k][a:b] for k in (*names, "asked")} | {"side": cols["own"][a:b]})
        if held:
            yield from finish()

    by = ["bucket", "word", "i", "j"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(scan, _MADE)


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """set, words (sorted 64-bit hashes) of the wanted sets, and of some others: the scan knows them by a bitmap of fixed size."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(wanted, "set"))

    def work(batch):
        import pyarrow as pa

        own = Lines(batch.column("text").to_pylist())
        hit = np.flatnonzero(is_marked(shared.value, own.set))
        hit = hit[np.unique(own.set[hit], return_index=True)[1]]
        yield {"set": own.set[hit], "words": pa.array(own.packed_words(hit), pa.binary())}

    return map_arrow(rows, work, "set long, words binary").dropDuplicates(["set"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """late of the pairs (late, early) that are similar on full sets."""
    one, two = (sets.select(F.col("set").alias(k), F.col("words").alias(w)) for k, w in (("late", "x"), ("early", "y")))

    def work(batch):
        late, x, y = batch.column("late").to_numpy(), batch.column("x").to_pylist(), batch.column("y").to_pylist()
        sizes = [np.fromiter((len(w) >> 3 for w in side), np.int64, len(late)) for side in (x, y)]
        words, pair = np.frombuffer(b"".join(x + y), np.uint64), np.concatenate([np.repeat(np.arange(len(n)), n) for n in sizes])
        order = _ordered(pair, words, words)
        words, pair = words[order], pair[order]
        same = np.bincount(pair[1:][(words[1:] == words[:-1]) & (pair[1:] == pair[:-1])], minlength=len(late))
        yield {"late": late[100 * same >= percent * (sizes[0] + sizes[1] - same)]}

    return map_arrow(pairs.join(one, "late").join(two, "early").select("late", "x", "y"), work, "late long")


def _decided(made: DataFrame, sets_of, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets with an earlier match among the candidates made; those still open as some of their candidates were not kept, with their words, which sets_of gives for the sets wanted."""
    found = written(made.groupBy("late", "early").agg(F.max("alike").alias("alike"), F.max("more").alias("more")), "candidates")
    sets = written(sets_of(found.select(F.explode(F.array("late", "early")).alias("set"))), "sets")
    best = found.groupBy("late").agg(F.max(F.struct("alike", "early"))["early"].alias("early"))
    hit = written(_confirmed(best, sets, percent), "matched")
    rest = found.join(hit, "late", "left_anti").select("late", "early")
    gone = hit.union(written(_confirmed(rest, sets, percent).distinct(), "matched")).select(F.col("late").alias("set"))
    open_ = written(sets.join(found.where("more").select(F.col("late").alias("set")).distinct().join(gone, "set", "left_anti"), "set", "left_semi"), "undecided")
    drop(found, sets)
    return gone, open_


def removed_lines(rows: DataFrame, percent: int = PERCENT, keep: int = KEEP, hot: int = HOT, flush: int = FLUSH) -> DataFrame:
    """doc, mark, numbers (array) of the lines to be removed from rows (doc, mark, text)."""
    lines, counts, n = scanned(rows, flush)
    context = rows.sparkSession.sparkContext
    shared, buckets = context.broadcast(counts), 1 << min(30, max(10, (n // (4 * PER_BUCKET)).bit_length()))
    made = candidates(postings(rows, _of_texts, shared, percent, buckets, flush), percent, keep, False, hot)
    free_shuffles(rows.sparkSession)  # the postings, several times the size of what follows
    gone, undecided = _decided(made, lambda wanted: _sets(rows, wanted), percent)
    if not undecided.isEmpty():
        near = written(_near(rows, context.broadcast(bitmap(_asked_keys(undecided.select("words"), shared, percent), "key"))), "near")
        asked = context.broadcast(bitmap(undecided, "set"))
        made = candidates(postings(near, _of_words, shared, percent, buckets, flush, asked), percent, 0, True, hot)
        again, _ = _decided(made, lambda wanted: near.select("set", "words").join(wanted.distinct(), "set", "left_semi").dropDuplicates(["set"]), percent)
        gone = gone.union(again)
        drop(near)
    drop(undecided)
    out = _gone(lines, gone.distinct(), buckets)
    return out.groupBy("doc", "mark").agg(F.collect_set("number").alias("numbers"))


def _rows(docs: DataFrame):
    return docs.select(F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("doc"), F.xxhash64(utf8()).alias("mark"), utf8().alias("text"))


def cut(text: bytes, numbers: list[int] | None) -> bytes:
    if not numbers:
        return text
    gone = set(numbers)
    return b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone)


def _masks(gone: DataFrame) -> DataFrame:
    """doc, mark, mask: a byte for each line, 1 where it goes."""

    def work(batch):
        masks = []
        for numbers in batch.column("numbers").to_pylist():
            mask = np.zeros(max(numbers) + 1, np.uint8)
            mask[numbers] = 1
            masks.append(mask.tobytes())
        yield {"doc": batch.column("doc"), "mark": batch.column("mark"), "mask": masks}

    return map_arrow(gone, work, "doc long, mark long, mask binary")


def dedup_lines(docs: DataFrame, percent: int = PERCENT, keep: int = KEEP) -> DataFrame:
    """docs with text without its later matches, and n_chars (if docs has it) the new length; null texts stay null. docs may have any columns beside doc_id and text."""
    names = docs.columns
    # The row travels as one struct, so that no column's name can clash.
    whole = docs.select(F.struct(*[docs[c] for c in names]).alias("row"))
    whole = whole.select("row", F.coalesce("row.doc_id", F.lit(LAST)).cast("long").alias("doc"), F.xxhash64(utf8("row.text")).alias("mark"))
    out = whole.join(_masks(removed_lines(_rows(docs), percent, keep)), ["doc", "mark"], "left")
    left = F.filter(F.split("row.text", "\n"), lambda x, i: F.substring("mask", i + 1, F.lit(1)) != F.lit(b"\x01"))
    text = F.when(F.col("mask").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    out = out.select("row", "mask", text.alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("mask").isNull(), F.col("row.n_chars")).otherwise(F.char_length("text").cast("long")) if "n_chars" in names else None}
    return out.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in names])


def line_digests(docs: DataFrame, percent: int = PERCENT, keep: int = KEEP) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 for each row."""
    rows = _rows(docs)
    gone = removed_lines(rows, percent, keep)

    def work(batch):
        n, removed, out = [], [], []
        for text, numbers in zip(batch.column("text").to_pylist(), batch.column("numbers").to_pylist()):
            n.append(text.count(b"\n") + 1)
            removed.append(len(numbers or ()))
            out.append(hashlib.sha256(cut(text, numbers)).hexdigest())
        yield {"doc_id": batch.column("doc_id"), "n_lines": n, "n_removed": removed, "kept_sha256": out}

    joined = rows.join(gone, ["doc", "mark"], "left").select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "text", "numbers")
    return map_arrow(joined, work, "doc_id long, n_lines long, n_removed long, kept_sha256 string")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(documents(spark, sf_dir))
