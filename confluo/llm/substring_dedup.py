"""Removal of repeated passages by suffix automata of reference shards.

The corpus is its own reference, so the automata are not sent to every task, which would stream every
document through every shard; instead the pieces that can match are brought to their shard. Each window
of SPAN words picks the smallest hash among its GRAM-word runs as its anchor (the leftmost of equals), so
equal windows have equal anchors. The windows of one document that share an anchor place make a fragment.

1. Anchors met once in the corpus are done: none of their windows repeats. Where all fragments of an
   anchor are equal, every window of theirs repeats.
2. The distinct fragments of all other anchors, with their multiplicities, are dealt out by anchor. A
   task takes whole anchors up to SHARD_WORDS words as a reference shard, builds its suffix automaton
   with the number of occurrences of each state, and streams the fragments through it: the state of the
   longest match, cut at SPAN words, tells whether the window ending there occurs twice or more. A
   window lies in exactly one fragment, so nothing is counted twice.
3. An anchor with more than HOT distinct fragments (a common passage in ever other surroundings) does not
   go to one task: its windows are counted by their own 64-bit hashes, with partial sums.

Spans come back to their documents, touching ones merge, and the words they cover go. Words are compared
by 64-bit hashes. Null texts have no words; an empty table gives an empty result; texts are taken whole. Documents are known by (doc_id, hash of the text), nulls
included, so repeated rows are copies of each other and lose what they share.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm.common import MULT, documents, drop, map_arrow, mixed, shingles, utf8, word_hashes, written

SPAN, GRAM = 35, 8
SHARD_WORDS, HOT = 40_000, 4096


def _powers(n: int) -> np.ndarray:
    out = np.full(n, MULT, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_INVERSE = np.uint64(pow(int(MULT), -1, 1 << 64))


def ranges_hash(words: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of words[a:b] for each a, b: equal sequences have equal hashes wherever they are."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(len(words)))])
    back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(words), _INVERSE, np.uint64)]))
    return mixed((sums[stop] - sums[start]) * back[start] + (stop - start).astype(np.uint64))


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost smallest value of each window."""
    at, size = np.arange(len(values)), 1
    pick = lambda a, b: np.where(values[a] <= values[b], a, b)
    while 2 * size <= width:
        at, size = pick(at[:-size], at[size:]), 2 * size
    return pick(at[: len(at) - (width - size)], at[width - size :]) if size < width else at


def fragments(words: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """anchor hash, fragment hash, first word, end word (past the last) of each fragment."""
    if len(words) < span:
        return (np.zeros(0, np.int64),) * 4
    grams = shingles(words, gram)
    at = _leftmost_least(grams, span - gram + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    end = last + span
    # The anchor's place in the fragment belongs to its hash: equal words around other anchors differ.
    whole = mixed(ranges_hash(words, first, end) ^ mixed((at[first] - first).astype(np.uint64)))
    return grams[at[first]].view(np.int64), whole.view(np.int64), first, end


class Automaton:
    """A suffix automaton of several sequences, with the weighted number of places where each state's strings end."""

    def __init__(self):
        self.next, self.link, self.len, self.count = [{}], [-1], [0], [0]

    def add(self, sequence: list[int], weight: int) -> None:
        nxt, link, length, count = self.next, self.link, self.len, self.count
        last = 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
            elif q is not None:
                last = self._split(last, c, q)
            else:
                new, p = len(length), last
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                count.append(0)
                while p != -1 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p != -1:
                    q = nxt[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = new
            count[last] += weight

    def _split(self, p: int, c: int, q: int) -> int:
        copy = len(self.len)
        self.next.append(dict(self.next[q]))
        self.len.append(self.len[p] + 1)
        self.link.append(self.link[q])
        self.count.append(0)
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def finish(self) -> None:
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.count[self.link[v]] += self.count[v]

    def repeated(self, sequence: list[int], span: int, least: int = 2) -> list[int]:
        """The ends (places past the last item) of windows of span items that occur least times or more."""
        state, size, out = 0, 0, []
        for i, c in enumerate(sequence):
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.len[state]
            if c in self.next[state]:
                state, size = self.next[state][c], size + 1
            while state and self.len[self.link[state]] >= span:
                state = self.link[state]
                size = self.len[state]
            if size >= span and self.count[state] >= least:
                out.append(i + 1)
        return out


def spans_of(ends: list[int], span: int) -> list[tuple[int, int]]:
    """Windows by their ends, in order, merged to maximal spans."""
    out: list[tuple[int, int]] = []
    for e in ends:
        if out and e - span <= out[-1][1]:
            out[-1] = (out[-1][0], e)
        else:
            out.append((e - span, e))
    return out


def _anchored(docs: DataFrame, span: int) -> DataFrame:
    def work(batch):
        texts, n, parts = batch.column("text").to_pylist(), [], []
        for t in texts:
            parts.append(fragments(word_hashes(t.split()), span))
            n.append(len(parts[-1][0]))
        row = np.repeat(np.arange(len(n)), n)
        anchor, fragment, first, end = (np.concatenate(x) if parts else [] for x in zip(*parts))
        yield {"anchor": anchor, "fragment": fragment, "doc_id": batch.column("doc_id").take(_index(row)), "mark": batch.column("mark").take(_index(row)), "first": first.astype(np.int32), "end": end.astype(np.int32)}

    return written(map_arrow(docs, work, f"anchor long, fragment long, doc_id {dict(docs.dtypes)['doc_id']}, mark long, first int, end int"), "anchors")


def _index(row: np.ndarray):
    import pyarrow as pa

    return pa.array(row, pa.int64())


def _with_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """anchor, fragment, n, hot, words (64-bit hashes) of the fragments wanted, from the documents that hold them."""
    import pyarrow as pa

    lists = wanted.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("anchor", "fragment", "n", "hot", "first", "end")).alias("want"))

    def work(batch):
        out = {k: [] for k in ("anchor", "fragment", "n", "hot", "words")}
        for text, want in zip(batch.column("text").to_pylist(), batch.column("want").to_pylist()):
            words = word_hashes(text.split())
            for w in want:
                for k in ("anchor", "fragment", "n", "hot"):
                    out[k].append(w[k])
                out["words"].append(words[w["first"] : w["end"]].tobytes())
        yield {k: pa.array(v, {"words": pa.binary(), "hot": pa.bool_()}.get(k, pa.int64())) for k, v in out.items()}

    return map_arrow(_matched(docs, lists), work, "anchor long, fragment long, n long, hot boolean, words binary")


def _matched(docs: DataFrame, by_document: DataFrame, how: str = "inner") -> DataFrame:
    """docs (doc_id, mark, text) with the columns of by_document, nulls equal."""
    right = by_document.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    return docs.join(right, docs["doc_id"].eqNullSafe(right["_id"]) & (docs["mark"] == right["_mark"]), how).drop("_id", "_mark")


def _by_automata(pieces: DataFrame, span: int, shard_words: int) -> DataFrame:
    """anchor, fragment, spans of the fragments in pieces, by the automaton of their shard."""

    def scan(batches):
        import pyarrow as pa

        def shard(held):
            machine = Automaton()
            lists = [np.frombuffer(w, np.uint64).tolist() for *_, w in held]
            for (_, _, n, _), s in zip(held, lists):
                machine.add(s, n)
            machine.finish()
            found = [spans_of(machine.repeated(s, span), span) for s in lists]
            rows = [(a, f, [{"a": x, "b": y} for x, y in spans]) for (a, f, *_), spans in zip(held, found) if spans]
            a, f, s = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(f, pa.int64()), pa.array(s, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], ["anchor", "fragment", "spans"])

        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("anchor", "fragment", "n", "words"))):
                if size >= shard_words and row[0] != last:
                    yield shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) // 8
                last = row[0]
        if held:
            yield shard(held)

    dealt = pieces.select("anchor", "fragment", "n", "words").repartition("anchor").sortWithinPartitions("anchor", "fragment")
    return dealt.mapInArrow(scan, "anchor long, fragment long, spans array<struct<a:int,b:int>>")


def _by_windows(pieces: DataFrame, span: int) -> DataFrame:
    """The same for hot anchors: windows counted by their hashes."""

    def work(batch):
        a, f, n, at, h = [], [], [], [], []
        for anchor, fragment, times, raw in zip(*(batch.column(k).to_pylist() for k in ("anchor", "fragment", "n", "words"))):
            words = np.frombuffer(raw, np.uint64)
            first = np.arange(len(words) - span + 1)
            h.append(ranges_hash(words, first, first + span).view(np.int64))
            at.append(first)
            a += [anchor] * len(first)
            f += [fragment] * len(first)
            n += [times] * len(first)
        yield {"anchor": a, "fragment": f, "n": n, "at": np.concatenate(at).astype(np.int32) if at else [], "window": np.concatenate(h) if h else []}

    windows = map_arrow(pieces, work, "anchor long, fragment long, n long, at int, window long")
    windows = written(windows, "windows")
    again = windows.groupBy("anchor", "window").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "window")
    span_of = F.struct(F.col("at").alias("a"), (F.col("at") + span).alias("b"))
    return windows.join(again, ["anchor", "window"]).groupBy("anchor", "fragment").agg(F.collect_list(span_of).alias("spans"))


def repeated_spans(docs: DataFrame, span: int = SPAN, shard_words: int = SHARD_WORDS, hot: int = HOT) -> DataFrame:
    """doc_id, mark, spans (array of a, b in words) for documents (doc_id, mark, text) with repeated windows."""
    anchors = _anchored(docs, span)
    met = anchors.groupBy("anchor").agg(F.count("*").alias("times"), F.min("fragment").alias("low"), F.max("fragment").alias("high")).where("times > 1").select("anchor", (F.col("low") == F.col("high")).alias("same"))
    # Written, so that both sides of the join are dealt anew and one anchor's rows can be split.
    met = written(met, "met")
    shared = written(anchors.join(met, "anchor"), "shared")
    drop(anchors, met)
    whole = shared.where("same").select("doc_id", "mark", F.struct(F.col("first").alias("a"), F.col("end").alias("b")).alias("span"))
    mixed_ones = shared.where("NOT same")
    kinds = mixed_ones.groupBy("anchor", "fragment").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "first", "end")).alias("at"))
    kinds = written(kinds, "kinds")
    heat = written(kinds.groupBy("anchor").agg(F.count("*").alias("k")).where(F.col("k") > hot).select("anchor", F.lit(True).alias("hot")), "heat")
    wanted = kinds.join(heat, "anchor", "left").select("anchor", "fragment", "n", F.coalesce("hot", F.lit(False)).alias("hot"), "at.*")
    pieces = written(_with_words(docs, wanted), "pieces")
    verdict = _by_automata(pieces.where("NOT hot"), span, shard_words).unionByName(_by_windows(pieces.where("hot"), span))
    found = mixed_ones.join(verdict, ["anchor", "fragment"]).select("doc_id", "mark", "first", F.explode("spans").alias("s"))
    partly = found.select("doc_id", "mark", F.struct((F.col("first") + F.col("s.a")).alias("a"), (F.col("first") + F.col("s.b")).alias("b")).alias("span"))
    # A document's spans are at most as many as its words.
    return whole.union(partly).groupBy("doc_id", "mark").agg(F.collect_set("span").alias("spans"))


def kept_words(words: list[bytes], spans: list[dict] | None) -> list[bytes]:
    if not spans:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [s["a"] for s in spans], 1)
    np.add.at(edge, [s["b"] for s in spans], -1)
    gone = np.cumsum(edge)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def dedup_passages(docs: DataFrame, span: int = SPAN, shard_words: int = SHARD_WORDS, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, kept (the words left, joined by a space) for each row."""
    return _finish(docs, span, shard_words, hot, "kept binary", lambda kept: kept)


def _finish(docs: DataFrame, span: int, shard_words: int, hot: int, column: str, make) -> DataFrame:
    rows = docs.select("doc_id", F.xxhash64(utf8()).alias("mark"), utf8().alias("text"))
    spans = repeated_spans(rows, span, shard_words, hot)
    name = column.split()[0]

    def work(batch):
        n, gone, out = [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = text.split()
            kept = kept_words(words, found)
            n.append(len(words))
            gone.append(len(words) - len(kept))
            out.append(make(b" ".join(kept)))
        yield {"doc_id": batch.column("doc_id"), "n_words": n, "n_removed": gone, name: out}

    return map_arrow(_matched(rows, spans, "left").select("doc_id", "text", "spans"), work, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, {column}")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finish(documents(spark, sf_dir), SPAN, SHARD_WORDS, HOT, "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest())
