"""Similarity of pairs of strings. Flags are column functions; what works on words and characters takes the pairs of an Arrow batch at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

#: Cells of a table that is worked on at once, at most (or one pair's).
CELLS = 1 << 21
#: Characters in a block, at most, for which each gets bit rows of its own.
LETTERS = 254
#: Windows of characters that are sorted at once, at most (or one pair's): they should stay in a core's cache.
ROWS = 1 << 18


def common_subsequences(a: list[str], b: list[str]) -> np.ndarray:
    """The length of the longest common subsequence of each pair of strings: bit rows in 64-bit words, a step for each character of b, all pairs at once."""
    out = np.zeros(len(a), np.int32)
    size = np.fromiter((len(x) * len(y) for x, y in zip(a, b)), np.int64, len(a))
    # Pairs of like sizes share a block.
    order = np.argsort(size, kind="stable")
    order = order[size[order] > 0].tolist()
    while order:
        rows, wide, high = [], 0, 0
        while order:
            w, h = max(wide, len(a[order[-1]])), max(high, len(b[order[-1]]))
            if rows and (len(rows) + 1) * (w + 64 + h) > CELLS:
                break
            wide, high = w, h
            rows.append(order.pop())
        out[rows] = _block([a[i] for i in rows], [b[i] for i in rows], -(-wide // 64), high)
    return out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts, and the texts' lengths."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.fromiter(map(len, texts), np.int64, len(texts))


def _dense(codes: np.ndarray) -> tuple[np.ndarray, int]:
    """Characters numbered from 1 as they are met in the order of their codes, and how many there are."""
    met = np.zeros(int(codes.max(initial=0)) + 1, bool)
    met[codes] = True
    return np.cumsum(met, dtype=np.uint32)[codes], int(met.sum())


def _table(codes: np.ndarray, sizes: np.ndarray, width: int, fill: int, kind) -> np.ndarray:
    out = np.full((len(sizes), width), fill, kind)
    out[np.arange(width) < sizes[:, None]] = codes
    return out


def _hits(a: list[str], b: list[str], words: int, high: int):
    """For each place in the texts of b in turn: the places of its character in those of a, as bit rows."""
    (x, p), (y, q) = _codes(a), _codes(b)
    codes, met = _dense(np.concatenate([x, y]))
    # Fillers differ, so what is beyond a string's end matches nothing.
    x, y = _table(codes[: len(x)], p, 64 * words, 0, np.uint32), _table(codes[len(x) :], q, high, met + 1, np.uint32)
    if met > LETTERS:
        for j in range(high):
            yield np.packbits(x == y[:, j, None], axis=1, bitorder="little").view("<u8").T
        return
    # Few characters: the bit rows of each are made once.
    first = np.arange(len(a)) * (met + 2)
    x, y = (np.add(first, side.T, order="C") for side in (x, y))
    places = np.zeros((words, len(a) * (met + 2)), np.uint64)
    for i in range(int(p.max())):
        places[i >> 6][x[i]] |= np.uint64(1 << (i & 63))
    for at in y:
        yield [row.take(at) for row in places]


def _block(a: list[str], b: list[str], words: int, high: int) -> np.ndarray:
    row, one = [np.full(len(a), 0xFFFFFFFFFFFFFFFF, np.uint64) for _ in range(words)], np.uint64(1)
    for hits in _hits(a, b, words, high):
        carry = np.zeros(len(a), np.uint64)
        for k in range(words):
            hit = row[k] & hits[k]
            total = row[k] + hit
            over = total < hit
            total += carry
            carry = (over | (total < carry)) * one
            row[k] = total | (row[k] & ~hits[k])
    return sum(np.bitwise_count(~r).astype(np.int32) for r in row)


def _words(text: str) -> list[str]:
    return [w for w in text.split(" ") if w]


def sort_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """2 * lcs / (length + length) of the words in order; 0 if a side is blank."""
    # Texts stand in many pairs of a batch.
    known = {t: " ".join(sorted(_words(t))) for t in {*a, *b}}
    x, y = ([known[t] for t in side] for side in (a, b))
    both = np.fromiter((len(p) + len(q) if p and q else 0 for p, q in zip(x, y)), np.int64, len(x))
    return np.where(both > 0, 2.0 * common_subsequences(x, y) / np.maximum(both, 1), 0.0)


def set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """1 if one word set holds the other and they meet; else the best of the measures over common and own words; 0 if a side is blank."""
    known = {t: set(_words(t)) for t in {*a, *b}}
    common, left, right, none = [], [], [], np.zeros(len(a), bool)
    for i, (s, t) in enumerate(zip(a, b)):
        p, q = known[s], known[t]
        none[i] = not p or not q
        common.append(" ".join(sorted(p & q)))
        left.append(" ".join(sorted(p - q)))
        right.append(" ".join(sorted(q - p)))
    n, p, q = (np.fromiter(map(len, x), np.int64, len(a)) for x in (common, left, right))
    gap = (n > 0).astype(np.int64)
    with np.errstate(invalid="ignore", divide="ignore"):
        own = 1.0 - (p + q - 2 * common_subsequences(left, right)) / ((n + gap + p) + (n + gap + q))
        part = lambda k: 1.0 - (gap + k) / (n + n + gap + k)
        out = np.where(n == 0, own, np.maximum(own, np.maximum(part(p), part(q))))
    return np.where(none, 0.0, np.where((n > 0) & ((p == 0) | (q == 0)), 1.0, out))


def gram_jaccards(a: list[str], b: list[str], n: int = 3) -> np.ndarray:
    """The Jaccard similarity of the sets of windows of n characters, n being 3 at most, of each pair; a shorter string is its own window; 0 if a side is blank."""
    out = np.zeros(len(a))
    wide = np.fromiter((max(len(x), len(y)) if x.strip(" ") and y.strip(" ") else 0 for x, y in zip(a, b)), np.int64, len(a))
    # Pairs of like sizes share a block.
    order = np.argsort(wide, kind="stable")
    start = int(np.searchsorted(wide[order], 1))
    while start < len(order):
        stop = min(start + max(1, ROWS // (2 * int(wide[order[start]]))), len(order))
        # The last pair of a block is its longest.
        while stop > start + 1 and (stop - start) * 2 * int(wide[order[stop - 1]]) > ROWS:
            stop = start + max(1, ROWS // (2 * int(wide[order[stop - 1]])))
        rows = order[start:stop]
        out[rows] = _gram_jaccards([a[i] for i in rows], [b[i] for i in rows], n)
        start = stop
    return out


def _gram_jaccards(a: list[str], b: list[str], n: int) -> np.ndarray:
    """Of pairs that are not blank: a row holds both strings' windows, each with its side in the last bit, so one sort of the rows tells the sizes of sum and union."""
    codes, sizes = _codes(a + b)
    codes, met = _dense(codes)
    bits, width = met.bit_length(), int(sizes.max())
    kind = np.uint32 if n * bits < 31 else np.uint64
    top = np.iinfo(kind).max
    chars = np.zeros((len(sizes), width + n - 1), kind)
    chars[np.arange(width + n - 1) < sizes[:, None]] = codes
    windows = chars[:, :width]
    for k in range(1, n):
        windows = windows << kind(bits) | chars[:, k : width + k]
    windows = windows << kind(1)
    windows[len(a) :] |= kind(1)
    windows[np.arange(width) >= np.maximum(sizes - (n - 1), 1)[:, None]] = top
    rows = np.concatenate([windows[: len(a)], windows[len(a) :]], axis=1)
    rows.sort(axis=1)
    least = (rows[:, 0] != top).astype(np.int64)
    step = rows[:, 1:] ^ rows[:, :-1]
    step[rows[:, 1:] == top] = 0
    both, union = least + np.count_nonzero(step, axis=1), least + np.count_nonzero(step > 1, axis=1)
    return (both - union) / union


def word_jaccards(a: list[str], b: list[str]) -> np.ndarray:
    """The Jaccard similarity of the word sets of each pair; 0 if a side is blank."""
    known = {t: set(_words(t)) for t in {*a, *b}}
    out = np.zeros(len(a))
    for i, (s, t) in enumerate(zip(a, b)):
        p, q = known[s], known[t]
        if p and q:
            same = len(p & q)
            out[i] = same / (len(p) + len(q) - same)
    return out


def _once(measure, a: list[str], b: list[str]) -> np.ndarray:
    """The measure of each pair, where equal pairs are measured once: records with equal texts meet the same others."""
    known: dict[tuple[str, str], int] = {}
    at = [known.setdefault(pair, len(known)) for pair in zip(a, b)]
    return measure(a, b) if len(known) == len(at) else measure(*map(list, zip(*known)))[at]


def _arrow(measure, kind):
    """A Column function of two strings from one that works on lists."""
    made = F.pandas_udf(lambda x, y: pd.Series(_once(measure, x.tolist(), y.tolist())), kind)
    return lambda x, y: made(F.coalesce(x, F.lit("")), F.coalesce(y, F.lit("")))


lcs_length = _arrow(common_subsequences, IntegerType())
token_sort_ratio = _arrow(sort_ratios, DoubleType())
token_set_ratio = _arrow(set_ratios, DoubleType())
gram_jaccard = _arrow(gram_jaccards, DoubleType())
token_jaccard = _arrow(word_jaccards, DoubleType())


def either_blank(x: Column, y: Column) -> Column:
    return (F.trim(x) == "") | (F.trim(y) == "")


def three_state(x: Column, y: Column) -> Column:
    """-1 if a side is blank, else 1 or 0 for equality regardless of case."""
    return F.when(either_blank(x, y), -1.0).otherwise((F.lower(F.trim(x)) == F.lower(F.trim(y))).cast("double"))


def either(x: Column, y: Column) -> Column:
    return (F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False))).cast("double")
