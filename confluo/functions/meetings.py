"""Similarity of pairs of which many in a batch have one right side, as pairs that come out of a join by candidate have.

A right side's parts go to a table once and the left sides look theirs up, so a pair costs a look-up for each part and no sort.
What depends on one text alone (how many windows, which words) comes with the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from confluo.functions.similarity import gram_jaccards

#: Bytes of text of the pairs that are worked on at once, at most (or one pair's); cells of a table of words.
TEXT = 1 << 22
#: Right sides whose windows stand in tables at once, and the places of such a table, at most.
RIGHTS, WINDOWS = 16, 1 << 18


def gram_count(text: str) -> int:
    """How many windows of three characters a text has, each counted once; a shorter text is its own window."""
    return len({text[i : i + 3] for i in range(max(1, len(text) - 2))})


def word_set(text: str) -> str:
    """The words of a text, each once, joined by spaces."""
    return " ".join(dict.fromkeys(w for w in text.split(" ") if w))


def _slices(a: pa.Array, b: pa.Array) -> Iterator[slice]:
    ends = np.cumsum(pc.binary_length(a).to_numpy().astype(np.int64) + pc.binary_length(b).to_numpy())
    start = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TEXT, "right")))
        yield slice(start, stop)
        start = stop


def _meeting(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """An order of the pairs by right side, the left sides in it, the distinct right sides, each pair's, and where a right side's pairs begin."""
    coded = b.dictionary_encode()
    of = coded.indices.to_numpy().astype(np.int64)
    order = np.argsort(of, kind="stable")
    of = of[order]
    return order, a.take(pa.array(order)), coded.dictionary, of, np.searchsorted(of, np.arange(len(coded.dictionary) + 1))


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def _windows(raw: np.ndarray, at: np.ndarray, base: int) -> np.ndarray:
    """The window of three that begins at each place, in digits to a base (0: no character); 0 at a text's last two places if it is longer than those."""
    out = raw.astype(np.int64)
    out *= base
    out[:-1] += raw[1:]
    out *= base
    out[:-2] += raw[2:]
    sizes, ends = np.diff(at), at[1:]
    one, two = ends[sizes == 1] - 1, ends[sizes == 2] - 2
    out[one], out[two] = raw[one].astype(np.int64) * base**2, (raw[two].astype(np.int64) * base + raw[two + 1]) * base
    for n in (1, 2):
        out[ends[sizes > n] - n] = 0
    return out


def gram_meetings(a: pa.Array, b: pa.Array, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What gram_jaccards gives, for texts without nulls that have p and q distinct windows."""
    out, sides = np.zeros(len(a)), (a, b)
    real = np.logical_and(*[pc.not_equal(pc.utf8_trim(x, " "), "").to_numpy(zero_copy_only=False) for x in sides])
    plain = np.logical_and(*[pc.equal(pc.utf8_length(x), pc.binary_length(x)).to_numpy(zero_copy_only=False) for x in sides])
    for fast in (True, False):
        at = np.flatnonzero(real & (plain == fast))
        x, y = a.take(pa.array(at)), b.take(pa.array(at))
        for rows in _slices(x, y):
            shared = _shared_windows(x[rows], y[rows]) if fast else None
            out[at[rows]] = gram_jaccards(x[rows].to_pylist(), y[rows].to_pylist()) if shared is None else shared / (p[at[rows]] + q[at[rows]] - shared)
    return out


def _shared_windows(a: pa.Array, b: pa.Array) -> np.ndarray | None:
    """How many windows each pair of ASCII texts shares; None if they have too many characters for a table of all windows."""
    order, a, rights, of, first = _meeting(a, b)
    (left, left_at), (right, right_at) = _bytes(a), _bytes(rights)
    number = np.zeros(256, np.uint8)
    number[left] = number[right] = 1
    base = int(number.sum()) + 1
    if base**3 > WINDOWS:
        return None
    number = np.cumsum(number, dtype=np.uint8) * number
    left, right = _windows(number[left], left_at, base), _windows(number[right], right_at, base)
    n, m = np.diff(left_at), np.diff(right_at)
    shared = np.zeros(len(order), np.int64)
    table = np.zeros(RIGHTS * base**3, np.int32)
    for r in range(0, len(rights), RIGHTS):
        s = min(r + RIGHTS, len(rights))
        known, i, j = right[right_at[r] : right_at[s]], first[r], first[s]
        own, size = of[i:j], n[i:j]
        place = np.repeat(np.arange(s - r) * base**3, m[r:s]) + known
        table[place] = np.arange(1, len(known) + 1)
        table[np.arange(s - r) * base**3] = 0
        found = table[np.repeat((own - r) * base**3, size) + left[left_at[i] : left_at[j]]]
        hit = np.flatnonzero(found)
        # A mark for each window of a pair's right side, so a repeated window counts once.
        begin = _starts(m[own])
        marks = np.zeros(begin[-1], np.uint8)
        marks[np.repeat(begin[:-1] - right_at[own] + right_at[r] - 1, size)[hit] + found[hit]] = 1
        shared[order[i:j]] = np.add.reduceat(marks, begin[:-1], dtype=np.int64)
        table[place] = 0
    return shared


def word_meetings(a: pa.Array, b: pa.Array) -> np.ndarray:
    """What word_jaccards gives, for word sets (word_set) without nulls."""
    out = np.zeros(len(a))
    real = np.flatnonzero(pc.and_(pc.not_equal(a, ""), pc.not_equal(b, "")).to_numpy(zero_copy_only=False))
    a, b = a.take(pa.array(real)), b.take(pa.array(real))
    for rows in _slices(a, b):
        out[real[rows]] = _word_jaccards(a[rows], b[rows])
    return out


def _word_jaccards(a: pa.Array, b: pa.Array) -> np.ndarray:
    order, a, rights, of, first = _meeting(a, b)
    lists = [pc.split_pattern(x, " ") for x in (a, rights)]
    n, m = (pc.list_value_length(x).to_numpy().astype(np.int64) for x in lists)
    coded = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
    words, met = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    left_at, right_at = _starts(n), _starts(m)
    left, right = words[: left_at[-1]], words[left_at[-1] :]
    shared, step = np.zeros(len(order), np.int64), max(1, TEXT // met)
    table = np.zeros(min(step, len(rights)) * met, bool)
    for r in range(0, len(rights), step):
        s = min(r + step, len(rights))
        i, j = first[r], first[s]
        place = np.repeat(np.arange(s - r) * met, m[r:s]) + right[right_at[r] : right_at[s]]
        table[place] = True
        hits = table[np.repeat((of[i:j] - r) * met, n[i:j]) + left[left_at[i] : left_at[j]]]
        shared[i:j] = np.add.reduceat(hits, left_at[i:j] - left_at[i], dtype=np.int64)
        table[place] = False
    out = np.zeros(len(order))
    out[order] = shared / (n + m[of] - shared)
    return out
