"""The corpus pipeline, stage by stage, beside brute force; extra columns carry the operators' own names."""

import hashlib
import random
import re
import xxhash
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline
from confluo.llm import byte_bpe, line_dedup, quality_rules

EXTRA = ["numbers", "_mark", "_doc", "_row", "want", "spans", "mark", "row", "doc", "kept", "mask", "stratum", "_q", "regions", "set"]
STAGES = dict(corpus_pipeline.STAGES)


def make_documents():
    rnd = random.Random(8)
    word = lambda: rnd.choice([f"w{rnd.randrange(5000)}"] * 30 + ["the", "of", "naïve", "X1"])
    sentence = lambda n: " ".join(word() for _ in range(n))
    items = [sentence(12) for _ in range(5)]
    texts = [None, "", "few words", "! # " * 40, "same words here " * 30]
    shared = [sentence(14) for _ in range(6)]
    for i in range(120):
        lines = [sentence(rnd.randint(8, 30)) for _ in range(3)]
        if i % 4 == 0:
            lines.insert(1, rnd.choice(shared))
        if i % 9 == 0:
            lines.append(sentence(5) + " " + items[i % 5].upper() + " " + sentence(5))
        texts.append("\n".join(lines))
        if i % 5 == 0:
            x = texts[-1].split(" ")
            x[rnd.randrange(len(x))] = "other"
            texts.append(" ".join(x))
        if i % 7 == 0:
            texts.append(texts[-1])
        if i % 6 == 1:  # the same words in other lines
            x = texts[-1].split()
            texts.append("\n".join(" ".join(x[k : k + 5]) for k in range(0, len(x), 5)))
    rows = [(i if i != 9 else None, t, rnd.choice(["en", "fr", None]), "src", len(t) if t else 0) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (14, rows[13][1], "en", "src", 3)]
    rnd.shuffle(rows)
    return rows, items


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def failed(t):
    w = words(t)
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    met, cover = Counter(windows), set()
    for k, x in enumerate(windows):
        if met[x] > 1:
            cover.update(range(k, k + 8))
    return len(w) < 20 or 100 * len(cover) > 30 * len(w)


def without_lines(rows):
    """The rows with their lines less those that match an earlier one."""
    lines = []
    for i, t in {(r[0], r[1]) for r in rows}:
        raw = (t or "").encode()
        mark = int(np.uint64(xxhash.xxh64_intdigest(raw, seed=42)).view(np.int64))
        for k, x in enumerate(raw.split(b"\n")):
            if s := frozenset(x.split()):
                lines.append(((line_dedup.LAST if i is None else i), k, int(line_dedup.Lines([x]).set[0]), mark, s, (i, t)))
    lines.sort(key=lambda x: x[:4])
    gone = defaultdict(set)
    for a, (_, k, _, _, s, row) in enumerate(lines):
        if any(100 * len(s & o) >= 75 * len(s | o) for *_, o, _ in lines[:a]):
            gone[row].add(k)
    out = []
    for r in rows:
        t = r[1]
        if cut := gone[r[0], r[1]]:
            t = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut)
        out.append((r[0], t, *r[2:4], len(t) if cut else r[4]))
    return out


def without_copies(rows):
    sets = []
    for r in rows:
        w = words((r[1] or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    known = [k for k, r in enumerate(rows) if r[0] is not None]
    root = {k: k for k in known}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in known:
        for b in known:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k in known:
        least[find(k)] = min(rows[k][0], least.get(find(k), rows[k][0]))
    kept = {(r[0], r[1]) for k, r in enumerate(rows) if r[0] is None or r[0] == least[find(k)]}
    return [r for r in rows if (r[0], r[1]) in kept]


def edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_stages_beside_brute_force(spark, tmp_path):
    rows, items = make_documents()
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    whole = [(*r, *range(len(EXTRA))) for r in rows]
    docs = spark.createDataFrame(whole, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in EXTRA)).repartition(5)
    bag = lambda df: Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())

    def run(name, left):
        out = STAGES[name](spark, left, str(tmp_path))
        assert out.columns == docs.columns, name
        out = out.cache()
        assert out.select(*EXTRA).distinct().collect() == [tuple(range(len(EXTRA)))]
        return out

    # So few labels certify no cutoff: what the base counts fail goes.
    left, want = run("quality_rules", docs), [r for r in rows if not failed(r[1])]
    assert bag(left) == Counter(want) and 0 < len(want) < len(rows)
    left, before, want = run("line_dedup", left), want, without_lines(want)
    assert bag(left) == Counter(want) != Counter(before)
    left, before, want = run("near_dedup", left), want, without_copies(want)
    assert bag(left) == Counter(want) and 0 < len(want) < len(before)
    near = [" ".join(x.lower().split()) for x in items]
    left, before, want = run("decontamination", left), want, [r for r in want if all(edits(x, " ".join((r[1] or "").lower().split())) > len(x) // 10 for x in near)]
    assert bag(left) == Counter(want) and 0 < len(want) < len(before)
    enc, sha = byte_bpe.encoding_of(*byte_bpe.production()), lambda b: hashlib.sha256(b).hexdigest()
    got = Counter(tuple(r) for r in STAGES["byte_bpe"](spark, left, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == Counter((r[0], len(ids := enc.encode_ordinary(r[1] or "")), sha(np.array(ids, "<u4").tobytes()), sha((r[1] or "").encode())) for r in want)


def test_run_is_the_stages_in_turn(spark, tmp_path):
    rows, items = make_documents()
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    want = without_copies(without_lines([r for r in rows if not failed(r[1])]))
    near = [" ".join(x.lower().split()) for x in items]
    want = [r for r in want if all(edits(x, " ".join((r[1] or "").lower().split())) > len(x) // 10 for x in near)]
    assert Counter(r.doc_id for r in got.collect()) == Counter(r[0] for r in want)
    assert list(quality_rules.RULES)


def test_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, form in (("documents", schema), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int")):
        spark.createDataFrame([], form).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
