"""The classifier beside a plain follow-the-regularised-leader, the rules' cutoffs beside exact sums, and odd tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from confluo.llm import quality_model as qm
from confluo.llm import quality_rules as qr

LABELS = "doc_id long, quality int"


def plain_weights(rows, bits):
    """Per-coordinate FTRL, one place at a time, over rows (places, values, label)."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= qm.L1:
            return 0.0
        return -(z[i] - math.copysign(qm.L1, z[i])) / ((qm.SMOOTH + math.sqrt(n[i])) / qm.RATE + qm.L2)

    for at, value, label in rows:
        w = [weight(i) for i in at]
        p = 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(w, value))))))
        for i, x, wi in zip(at, value, w):
            g = (p - label) * x
            s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / qm.RATE
            z[i] += g - s * wi
            n[i] += g * g
    return np.array([weight(i) for i in range(1 << bits)])


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def make(n=60):
    rnd = random.Random(4)
    good, bad = [f"g{i}" for i in range(50)], ["BUY", "now", "!!!", "free", "$$$"]
    rows = [(i, " ".join(rnd.choice(good if i % 2 else bad) for _ in range(rnd.randint(1, 30)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (None, "g1 g2"), (n + 3, "x" * 50_000), (n + 4, "g1 " * 20_000)]


def test_weights_and_scores_beside_plain_python(spark):
    rows, bits = make(), 12
    labels = [(i, i % 2) for i in range(60)] + [(1, 0), (2, 1), (None, 1), (5, None), (60, 1), (61, 0)]
    docs = spark.createDataFrame([(i, t, 7, "f", [1]) for i, t in rows], "doc_id long, text string, _label int, features string, at array<int>").repartition(3)
    weights = qm.fit(docs, spark.createDataFrame(labels, LABELS), bits=bits)
    best = {}
    for i, q in labels:
        if i is not None and q is not None:
            best[i] = max(q, best.get(i, 0))
    known = {i: best[i] for i in best if not held(i)}
    order = {r.doc_id: r.o for r in spark.createDataFrame([(i,) for i in known], "doc_id long").select("doc_id", F.xxhash64("doc_id").alias("o")).collect()}
    text = {i: (t or "").encode() for i, t in rows}
    feats = lambda t: qm.features(t, bits)
    wide = lambda a, v: (a.tolist(), v.astype(np.float32).astype(np.float64).tolist())
    want = plain_weights([(*wide(*feats(text[i])), int(known[i] == 1)) for i in sorted(known, key=lambda i: (order[i], i)) if i in text], bits)
    assert np.allclose(weights, want, atol=1e-5) and np.abs(want).max() > 0.1
    got = Counter((r.doc_id, r.held_out, round(r.score, 5), r.predicted) for r in qm.score(docs, weights).collect())
    plain = Counter()
    for i, t in rows:
        at, value = feats((t or "").encode())
        p = 1 / (1 + math.exp(-float(weights[at].astype(np.float64) @ value)))
        plain[i, held("" if i is None else i), round(p, 5), int(p >= qm.THRESHOLD)] += 1
    assert got == plain


def test_odd_tables(spark):
    docs = spark.createDataFrame(make(10), "doc_id long, text string")
    none = docs.where(F.lit(False))
    weights = qm.fit(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 1)], LABELS))
    assert qm.score(none, weights).count() == 0
    assert not qm.fit(none, spark.createDataFrame([(1, 1)], LABELS)).any()
    assert not qm.fit(docs, spark.createDataFrame([], LABELS)).any()
    twice = docs.union(docs)
    got = qm.score(twice, weights).groupBy("doc_id", "score").count().collect()
    assert {r["count"] for r in got} == {2} and all(0 <= r.score <= 1 for r in got)


def tail(n, k, p):
    return 1.0 if k > n * p else sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def signal(r, rule):
    share = lambda a, b, by=1000: by * a // b if b else 0
    return {"symbols": share(r.n_symbols, r.word_chars), "dup_lines": share(r.n_dup_lines, r.n_lines), "repeats": share(r.n_repeat_words, r.n_words), "marks": share(r.n_marks, r.word_chars), "capitals": share(r.n_capitals, r.word_chars), "word_length": share(r.word_chars, r.n_words, 100)}[rule]


def test_cutoffs_and_verdicts_beside_exact_sums(spark):
    """Three strata of unlike size and taste; repeated rows and labels count once."""
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(6000):
        lang = ("en", "fr", None)[0 if i % 10 < 7 else 1 if i % 10 < 9 else 2]
        bad = rnd.random() < 0.2
        words = [f"w{rnd.randrange(10**6)}" for _ in range(25)]
        if bad or rnd.random() < 0.0005:
            for _ in range(rnd.randint(2, 12)):
                words[rnd.randrange(25)] = rnd.choice(["a#b#", "!!!!", "SALE", "x" * 60, "$|$"])
        rows.append((i, " ".join(words[:12]) + "\n" + " ".join(words[12:]), lang))
        if rnd.random() < 0.9:
            labels.append((i, 0 if bad else 1))
    rows += rows[:40] + [(9000, None, "en"), (None, "a b", "en")]
    labels += labels[:30] + [(7, None), (None, 1)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), spark.createDataFrame(labels, LABELS)
    own = qr.signals(docs.select("doc_id", qr.stratum(), "text")).select("doc_id", "stratum", "_q.*").collect()
    good = {}
    for i, q in labels:
        if i is not None and q is not None:
            good[i] = max(q, good.get(i, 0))
    failed = lambda r: r.n_words < qr.MIN_WORDS or 100 * r.n_repeat_words > qr.MAX_REPEAT_PERCENT * r.n_words
    once = {r.doc_id: r for r in own if r.doc_id in good and not failed(r)}
    strata = {r.stratum for r in once.values()}
    tests = len(strata) * sum(map(len, qr.RULES.values()))
    cutoffs = defaultdict(dict)
    for s in strata:
        mine = [r for r in once.values() if r.stratum == s]
        n = sum(good[r.doc_id] == 1 for r in mine)
        for rule, grid in qr.RULES.items():
            best = None
            for c in grid:
                over = [good[r.doc_id] == 1 for r in mine if signal(r, rule) > c]
                gain = (len(over) - sum(over)) - qr.COST * sum(over)
                if tail(n, sum(over), qr.ALPHA / len(qr.RULES)) <= qr.DELTA / tests and gain > 0:
                    best = max(best or (gain, c), (gain, c))
            if best:
                cutoffs[s][rule] = best[1]
    judged = qr.signals(docs.select("doc_id", qr.stratum(), "text")).select("doc_id", "stratum", "_q")
    got = {r.stratum: r.cutoffs for r in qr.certified(judged, known).collect()}
    assert got == dict(cutoffs) and cutoffs["en"]
    want = Counter((r.doc_id, not failed(r) and all(signal(r, rule) <= c for rule, c in cutoffs.get(r.stratum, {}).items())) for r in own)
    assert Counter((r.doc_id, r.kept) for r in qr.quality_rules(docs, known).collect()) == want
    assert sum(not k for _, k in want) > 50
