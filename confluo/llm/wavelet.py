"""Token ids as a wavelet matrix per shard.

The file format (WMX1), little-endian: magic, bits b, ids n, b zero counts, b plane lengths, then the
b bit-planes, each compressed with zstd. Plane 0 holds the ids' highest bits in order; plane i + 1
holds the next bit after a stable partition by plane i, zeros first. A plane is unpacked when it is first
used and has a directory of ones before each 512 bits (a sixteenth of the plane), so rank takes constant
time, and access, count and occurrence lookup take one rank or select for each plane.

A shard is a run of whole documents in ascending doc_id order (null first, ties by text), closed once
it holds SHARD_IDS ids; a shard's file is one row of a Parquet table that Spark's writer commits, so
retried tasks and lost executors leave no half-written or doubled file. Null texts count as empty and
hold the end id alone. Repeated rows are documents of their own.
"""

from __future__ import annotations

import itertools
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from confluo.llm.common import documents, fresh_path, small_batches, span_hashes, utf8, word_spans
from confluo.llm.token_count import tokenizer

END_ID, SHARD_IDS = 1, 4_000_000
CACHE = 2_000_000
#: The mark of a pre-token's last id in this vocabulary.
WORD_END = "</w>"
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#*$%&|]*)")
MAGIC = b"WMX1"


def pack(ids: np.ndarray) -> bytes:
    """The file of a sequence of ids."""
    ids = np.asarray(ids, np.uint32)
    bits = max(1, int(ids.max()).bit_length() if len(ids) else 1)
    ids = ids.astype(np.uint16) if bits <= 16 else ids
    zeros, planes, press = [], [], zstandard.ZstdCompressor(level=1)
    for level in range(bits - 1, -1, -1):
        one = (ids & ids.dtype.type(1 << level)).astype(bool)
        planes.append(press.compress(np.packbits(one).tobytes()))
        low = ids.compress(~one)
        zeros.append(len(low))
        ids = np.concatenate([low, ids.compress(one)])
    head = struct.pack(f"<4sIQ{bits}Q{bits}Q", MAGIC, bits, len(ids), *zeros, *map(len, planes))
    return head + b"".join(planes)


class WaveletMatrix:
    """An opened file."""

    def __init__(self, blob: bytes):
        magic, self.bits, self.n = struct.unpack_from("<4sIQ", blob)
        if magic != MAGIC:
            raise ValueError("not a WMX1 file")
        rest = struct.unpack_from(f"<{2 * self.bits}Q", blob, 16)
        ends = np.cumsum([16 + 16 * self.bits, *rest[self.bits :]]).tolist()
        self.zeros, self._packed = rest[: self.bits], [blob[a:b] for a, b in zip(ends, ends[1:])]
        self._planes: dict[int, np.ndarray] = {}
        self._ones: dict[int, np.ndarray] = {}

    def plane(self, level: int) -> np.ndarray:
        """A plane's bits in bytes; unpacked when first used."""
        if level not in self._planes:
            raw = zstandard.ZstdDecompressor().decompress(self._packed[level], max_output_size=self.n // 8 + 64)
            self._planes[level] = np.frombuffer(raw, np.uint8)
        return self._planes[level]

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane: those before the block of 512 bits, and a count within it."""
        plane = self.plane(level)
        if level not in self._ones:
            bits = np.bitwise_count(np.pad(plane, (0, -len(plane) % 64))).reshape(-1, 64).sum(axis=1, dtype=np.uint64)
            self._ones[level] = np.concatenate([[0], np.cumsum(bits)]).astype(np.uint32 if self.n < 1 << 32 else np.uint64)
        block, (byte, rest) = i >> 9, divmod(i, 8)
        ones = int(self._ones[level][block]) + int(np.bitwise_count(plane[block << 6 : byte]).sum())
        return ones + (int(plane[byte] >> (8 - rest)).bit_count() if rest else 0)

    def _bit(self, level: int, i: int) -> int:
        return int(self.plane(level)[i >> 3] >> (7 - (i & 7))) & 1

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(self.bits):
            ones, bit = self._rank1(level, i), self._bit(level, i)
            out, i = out << 1 | bit, self.zeros[level] + ones if bit else i - ones
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        for level in range(self.bits):
            a, b = self._rank1(level, low), self._rank1(level, high)
            low, high = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.bits - 1 - level) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of a token from place low to before place high."""
        if token >> self.bits:
            return 0
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0); IndexError if there are fewer."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, self.n)[0] + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            k, low, high = (i - self.zeros[level] if bit else i), 0, self.n
            while low < high:  # the first place before which there are more than k such bits
                mid = (low + high) // 2
                ones = self._rank1(level, mid + 1)
                low, high = (low, mid) if (ones if bit else mid + 1 - ones) > k else (mid + 1, high)
            i = low
        return i

    def ids(self) -> np.ndarray:
        """The whole sequence, by undoing the partitions from the last plane up."""
        out = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.plane(level), count=self.n).view(bool)
            back = np.empty_like(out)
            back[np.flatnonzero(~one)] = out[: self.zeros[level]]
            back[np.flatnonzero(one)] = out[self.zeros[level] :] | out.dtype.type(1 << (self.bits - 1 - level))
            out = back
        return out


class Table:
    """64-bit hashes to row numbers: open addressing in arrays, all lookups and insertions at once."""

    def __init__(self, bits: int = 16):
        self.clear(bits)

    def clear(self, bits: int = 16) -> None:
        self.n, self.keys, self.rows = 0, np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        mask = np.uint64(len(self.keys) - 1)
        at = hashes & mask
        out = np.full(len(hashes), -1, np.int32)
        left = np.arange(len(hashes))
        while len(left):
            slot = at[left]
            key = self.keys[slot]
            hit = key == hashes[left]
            out[left[hit]] = self.rows[slot[hit]]
            left = left[~hit & (key != 0)]
            at[left] = at[left] + np.uint64(1) & mask
        return out

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """New rows, in order, for distinct hashes that are not there yet."""
        rows = np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        self.n += len(hashes)
        if 2 * self.n > len(self.keys):
            old = self.keys != 0
            keys, known, bits = self.keys[old], self.rows[old], max(16, (2 * self.n).bit_length())
            self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
            self._put(keys, known)
        self._put(hashes, rows)
        return rows

    def _put(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        at, left = hashes & mask, np.arange(len(hashes))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            self.keys[at[free]] = hashes[free]  # one of those that want a slot gets it
            won = free[self.keys[at[free]] == hashes[free]]
            self.rows[at[won]] = rows[won]
            left = left[self.keys[at[left]] != hashes[left]]
            at[left] = at[left] + np.uint64(1) & mask


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start to start + size - 1 of each run, joined."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class WordEncoder:
    """Ids of whole texts from the ids of their words. Sound for a tokenizer whose pre-tokens never hold ASCII white space, which it drops.

    Words are known by 64-bit hashes. A word of letters with marks behind it has the ids of its letters in lower case and
    those of the marks (`_PLAIN`), so the library gets each such part once.
    """

    def __init__(self, path: str, limit: int = CACHE):
        self.tok, self.limit = tokenizer(path), limit
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.kind = np.uint16 if len(self.last) <= 1 << 16 else np.uint32
        self._forget()

    def _forget(self) -> None:
        self.words, self.parts, self.held = Table(), Table(), 0
        self.ids = np.zeros(1 << 16, self.kind)
        # Start and size in ids of each word, and of each part.
        self.word_at, self.part_at = np.zeros((2, 1 << 12), np.int64), np.zeros((2, 1 << 12), np.int64)

    def _keep(self, ids: np.ndarray, sizes: np.ndarray, of: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The table of starts and sizes with the entries rows, whose ids are kept."""
        if self.held + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.held], np.zeros(max(len(self.ids), 2 * len(ids)), self.kind)])
        if len(rows) and rows[-1] >= of.shape[1]:
            of = np.concatenate([of, np.zeros((2, max(of.shape[1], 2 * len(rows))), np.int64)], axis=1)
        self.ids[self.held : self.held + len(ids)] = ids
        of[0, rows], of[1, rows] = self.held + np.cumsum(sizes) - sizes, sizes
        self.held += len(ids)
        return of

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each encoded alone, and how many each has."""
        lists = [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))

    def _encoded_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts of one pre-token each: many at a time, as each ends where an id that ends a word stands."""
        runs = self.tok.encode_batch_fast([" ".join(parts[i : i + 128]) for i in range(0, len(parts), 128)], add_special_tokens=False)
        ids = np.fromiter(itertools.chain.from_iterable([e.ids for e in runs]), np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        # Else it is not the kind of tokenizer whose last ids are marked.
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(parts) else self._encoded(parts)

    def _part_rows(self, parts: list[str]) -> np.ndarray:
        """Rows of parts, the new ones learnt."""
        raw = [p.encode() for p in parts]
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        hashes = span_hashes(b"".join(raw), np.concatenate([[0], ends[:-1]]), ends)
        rows = self.parts.find(hashes)
        missing = np.flatnonzero(rows < 0)
        new, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
        if len(new):
            ids, sizes = self._encoded_parts([parts[i] for i in missing[first].tolist()])
            added = self.parts.add(new)
            self.part_at = self._keep(ids, sizes, self.part_at, added)
            rows[missing] = added[back]
        return rows

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        """Learn the ids of new words."""
        letters, marks, plain, other, odd = [], [], [], [], []
        for i, w in enumerate(map(bytes.decode, words)):
            if m := _PLAIN.fullmatch(w):
                letters.append(m[1].lower())
                marks.append(m[2])
                plain.append(i)
            else:
                other.append(w)
                odd.append(i)
        if plain:
            start, sizes = np.zeros((2, len(plain), 2), np.int64)
            rows = self._part_rows(letters)
            start[:, 0], sizes[:, 0] = self.part_at[:, rows]
            behind = np.flatnonzero(np.fromiter(map(bool, marks), bool, len(marks)))
            if len(behind):
                rows = self._part_rows([marks[i] for i in behind.tolist()])
                start[behind, 1], sizes[behind, 1] = self.part_at[:, rows]
            ids = self.ids[_runs(start.ravel(), sizes.ravel())]
            self.word_at = self._keep(ids, sizes.sum(axis=1), self.word_at, self.words.add(hashes[plain]))
        if other:
            ids, sizes = self._encoded(other)
            self.word_at = self._keep(ids, sizes, self.word_at, self.words.add(hashes[odd]))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, joined, and how many each has."""
        raw = b"\n".join(texts)
        start, end = word_spans(np.frombuffer(raw, np.uint8))
        hashes = np.maximum(span_hashes(raw, start, end), np.uint64(1))  # 0 marks a free slot
        rows = self.words.find(hashes)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            if self.words.n + len(new) > self.limit and self.words.n:
                self._forget()
                missing = np.arange(len(hashes))
                new, first = np.unique(hashes, return_index=True)
            at = missing[first]
            self._learn([raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())], new)
            rows[missing] = self.words.find(hashes[missing])
        sizes = self.word_at[1, rows]
        ids = self.ids[_runs(self.word_at[0, rows], sizes)]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
        return ids, np.diff(before[ends], prepend=0)


_encoders: dict[str, WordEncoder] = {}


def write_shards(docs: DataFrame, path: str, out: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Write the shards of docs (doc_id, text) to the folder out."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_ids array<{kind}>, sizes array<int>, n_ids long, first_part int, first_row long, payload binary"
    small_batches(docs.sparkSession)

    def work(batches):
        from pyspark import TaskContext

        encoder = _encoders.setdefault(path, WordEncoder(path))
        part, row = TaskContext.get().partitionId(), 0
        names, sizes, chunks, held = [], [], [], 0

        def closed():
            ids, all_names, all_sizes = np.concatenate(chunks), pa.concat_arrays(names), np.concatenate(sizes).astype(np.int32)
            one = pa.array([0, len(all_names)], pa.int32())
            cols = [pa.ListArray.from_arrays(one, all_names), pa.ListArray.from_arrays(one, pa.array(all_sizes)), pa.array([len(ids)], pa.int64()), pa.array([part], pa.int32()), pa.array([row], pa.int64()), pa.array([pack(ids)], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, ["doc_ids", "sizes", "n_ids", "first_part", "first_row", "payload"])

        for batch in batches:
            ids, n = encoder.encode(batch.column("text").to_pylist())
            ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
            ends, a = np.cumsum(n), 0
            while a < len(n):
                # A shard takes whole documents until it holds shard_ids ids.
                begin = int(ends[a] - n[a])
                b = min(len(n), a + 1 + int(np.searchsorted(ends[a:] - begin, shard_ids - held)))
                chunks.append(ids[begin : ends[b - 1]])
                names.append(batch.column("doc_id").slice(a, b - a))
                sizes.append(n[a:b])
                held += len(chunks[-1])
                if held >= shard_ids:
                    yield closed()
                    row += sum(map(len, sizes))
                    names, sizes, chunks, held = [], [], [], 0
                a = b
        if names:
            yield closed()

    rows = docs.select("doc_id", utf8().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(work, schema).write.option("compression", "none").parquet(out)


def read_shards(spark: SparkSession, out: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.parquet(out)
    # One row a shard, without its ids: shards hold millions of ids each, so this table stays small.
    order = Window.orderBy("first_part", "first_row")
    base = files.select("first_part", "first_row", "n_ids").withColumn("base", F.sum("n_ids").over(order) - F.col("n_ids")).drop("n_ids")
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = memoryview(WaveletMatrix(batch.column("payload")[i].as_py()).ids().astype("<u4")).cast("B")
                sizes, names = batch.column("sizes")[i].values.to_numpy().astype(np.int64), batch.column("doc_ids")[i].values
                ends, n = np.cumsum(sizes), len(sizes)
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip((4 * (ends - sizes)).tolist(), (4 * ends).tolist())]
                yield pa.RecordBatch.from_arrays([names, pa.array(ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()), pa.array(np.full(n, batch.column("first_part")[i].as_py()), pa.int32()), pa.array(np.full(n, batch.column("first_row")[i].as_py()), pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32", "first_part", "first_row"])

    # A shard's blob is a few MB: one is handed over at a time.
    docs = files.mapInArrow(work, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, first_part int, first_row long")
    return docs.join(base, ["first_part", "first_row"]).select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def op5_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = fresh_path(spark, "wavelet")
    write_shards(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), out)
    return read_shards(spark, out)
