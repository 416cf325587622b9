"""Line dedup beside brute force: every line, text and digest, whatever the order of rows and however postings are dealt."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from confluo.llm import line_dedup


def make_rows(seed=3, n=160):
    """Lines over few and many words, near copies of lines, equal lines, null and repeated ids, repeated rows, blanks, very long lines."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "中文", "x" * 300, "A", "a", "\x1c", "b"]
    base = [[rnd.choice(words) for _ in range(rnd.choice([1, 3, 4, 7, 12, 30, 80]))] for _ in range(25)] + [[f"v{i}" for i in range(1500)]]

    def line():
        x = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, len(x) // 6])):
            x[rnd.randrange(len(x))] = rnd.choice(words + [f"u{rnd.randrange(10**9)}"] * 20)
        return rnd.choice([" ", "\t", "  "]).join(x)

    texts = ["\n".join(rnd.choice([line(), line(), "", " "]) for _ in range(rnd.randint(0, 6))) for _ in range(n)] + [None, "", "\n", " \n \n", "w1"]
    rows = [(rnd.choice([None, rnd.randrange(n), 10**15 + i, -i]), t) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (rows[7][0], rows[9][1])]
    rnd.shuffle(rows)
    return rows


def expected(rows):
    """doc_id, text left, n_removed of each row."""
    lines = []
    for i, t in set(rows):
        raw = (t or "").encode()
        mark = int(np.uint64(xxhash.xxh64_intdigest(raw, seed=42)).view(np.int64))
        for k, x in enumerate(raw.split(b"\n")):
            if s := frozenset(x.split()):
                lines.append(((line_dedup.LAST if i is None else i), k, int(line_dedup.Lines([x]).set[0]), mark, s, (i, t)))
    lines.sort(key=lambda x: x[:4])
    gone = Counter()
    left = {r: [(r[1] or "").encode().split(b"\n"), set()] for r in set(rows)}
    for a, (_, k, _, _, s, row) in enumerate(lines):
        if any(100 * len(s & o) >= 75 * len(s | o) for *_, o, _ in lines[:a]):
            left[row][1].add(k)
            gone[row] += 1
    text = {r: b"\n".join(x for k, x in enumerate(parts) if k not in out) for r, (parts, out) in left.items()}
    return Counter((r[0], None if r[1] is None else text[r].decode(), gone[r]) for r in rows)


ROWS = make_rows()
WANT = expected(ROWS)


@pytest.mark.parametrize(("keep", "hot", "flush"), [(4, 1 << 16, 1 << 19), (1, 1 << 16, 200), (1, 3, 1 << 19), (2, 1, 100)])
def test_every_line(spark, keep, hot, flush, monkeypatch):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3 if flush > 1000 else 7)
    rows = line_dedup._rows(docs)
    gone = {(r.doc, r.mark): set(r.numbers) for r in line_dedup.removed_lines(rows, keep=keep, hot=hot, flush=flush).collect()}
    got = Counter()
    for i, t in ROWS:
        raw = (t or "").encode()
        out = gone.get((line_dedup.LAST if i is None else i, int(np.uint64(xxhash.xxh64_intdigest(raw, seed=42)).view(np.int64))), set())
        got[(i, None if t is None else line_dedup.cut(raw, sorted(out)).decode(), len(out))] += 1
    assert got == WANT


def test_texts_and_digests(spark):
    docs = spark.createDataFrame([(i, t, 5, "m", [1], "d", None) for i, t in ROWS], "doc_id long, text string, n_chars long, mark string, numbers array<int>, _mark string, row int").repartition(5)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter({(i, t): 0 for i, t, _ in WANT}) + Counter(x for i, t, _ in WANT.elements() for x in [(i, t)])
    changed = {(i, t) for i, t, n in WANT if n}
    assert all(r.n_chars in (5, len(r.text or "")) for r in got) and all(r.n_chars == len(r.text) for r in got if (r.doc_id, r.text) in changed and (r.doc_id, r.text, 0) not in WANT)
    assert {(r.mark, tuple(r.numbers), r._mark, r.row) for r in got} == {("m", (1,), "d", None)}
    size = {}
    for i, t in ROWS:
        size.setdefault(i, Counter())[(t or "").count("\n") + 1] += 1
    digests = line_dedup.line_digests(docs).collect()
    assert Counter((r.doc_id, r.n_removed, r.kept_sha256) for r in digests) == Counter((i, n, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, n in WANT.elements())
    for i, lines in size.items():
        assert Counter(r.n_lines for r in digests if r.doc_id == i) == lines


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, numbers int")
    assert line_dedup.dedup_lines(docs).count() == 0 and line_dedup.line_digests(docs).count() == 0


def test_blocks_of_postings():
    rnd = np.random.default_rng(1)
    for big in (False, True):
        n = rnd.integers(1, 70_000 if big else 100, 50)
        x = {"word": rnd.integers(0, 1 << 32, 50).astype(np.uint32), "set": rnd.integers(-(1 << 63), (1 << 63) - 1, 50), "fold": rnd.integers(0, 1 << 63, 50).astype(np.uint64), "n": n, "place": rnd.integers(0, 300, 50), "number": rnd.integers(0, 1 << 31 if big else 9, 50), "asked": rnd.integers(0, 2, 50).astype(bool)}
        x["doc"] = np.array([line_dedup.LAST, -5, *range(48)]) if big else rnd.integers(7, 300, 50)
        x["high"] = np.where(n > line_dedup.WIDE, rnd.integers(0, 1 << 63, 50), 0).astype(np.uint64)
        back = [line_dedup.unpacked(b) for b in line_dedup.packed(x, np.array([0, 20, 20, 50]))]
        assert all((np.concatenate([b[k] for b in back]) == x[k]).all() for k in x)


def test_one_word_in_every_line(spark):
    """A word that all lines probe with, in more lines than one block of a hot word takes."""
    rnd = random.Random(6)
    rows = [(i, f"same {rnd.randrange(400)}") for i in range(1000)] + [(i, " ".join(["same", "b", "c", "d", f"e{rnd.randrange(30)}"])) for i in range(1000, 1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    gone = {r.doc for r in line_dedup.removed_lines(line_dedup._rows(docs), hot=64, flush=300).collect()}
    seen, want = [], set()
    for i, t in rows:
        s = frozenset(t.split())
        if any(100 * len(s & o) >= 75 * len(s | o) for o in seen):
            want.add(i)
        seen.append(s)
    assert gone == want
    assert docs.where(F.col("doc_id") < 0).count() == 0


@pytest.mark.parametrize("low", [0, 30, 60])
def test_order_is_that_of_a_full_sort(low):
    """By line, then key, equal ones as they come, also where keys differ in their last bits alone."""
    rnd = np.random.default_rng(low)
    line = rnd.integers(0, 300, 5000)
    words = rnd.integers(0, 1 << 64, 400, dtype=np.uint64)[rnd.integers(0, 400, 5000)] >> np.uint64(low)
    order = line_dedup._ordered(line, words, words)
    want = np.lexsort((words, line))
    assert (line[order] == line[want]).all() and (words[order] == words[want]).all() and len(set(order.tolist())) == 5000
