"""Operators beside brute force, on texts made to hold their hard cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline
from confluo.llm import byte_bpe, decontamination, line_dedup, lsh_forest, quality_model, quality_rules, registry, sharding, substring_dedup, token_count, wavelet
from confluo.llm.graph import components

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, spans int"
WORD = r"[^\x20\x09-\x0D]+"


def words(t):
    return re.findall(WORD, t or "")


def make_rows():
    """Copies, near copies, repeated lines and passages, nulls, blanks, repeated rows, odd characters; extra columns with operators' own names."""
    rnd = random.Random(11)
    vocabulary = ["alpha", "Beta", "γάμμα", "naïve", "it's", "12", "x" * 40, "中文", "<|endoftext|>", "é", "!!", "a,b", " ", "#"] + [f"w{i}" for i in range(300)]
    sentence = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, base = sentence(50), [sentence(120) for _ in range(4)]
    texts = [None, "", " \n\t", "one", "a b c d", "a b c d e", "z " * 400, "x" * 5000, " " * 900 + "end"]
    for i in range(60):
        t = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 5)):
            t[rnd.randrange(len(t))] = rnd.choice(vocabulary)
        texts.append(" ".join(t))
        texts.append("\n".join([sentence(rnd.randint(1, 40)), passage if i % 3 else "", sentence(8), texts[-1][:200]]))
    rows = [(i if i % 17 else None, t, ("en", "fr", None)[i % 3], "src", len(t or ""), "d", 1) for i, t in enumerate(texts)]
    return rows + [rows[20], rows[20], (7, "one\n\none", "en", None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_token_counts(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = token_count.tokenizer(path)
    want = Counter((i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False)), n > 512) for i, t, *_ in rows)
    got = token_count.count_tokens(docs, path, chunk=200, overlap=40)
    assert bag(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_count.count_tokens(empty, path).count() == 0


def test_splices_of_odd_texts():
    tok, rnd = token_count.tokenizer(public_tokenizers.path("byte_bpe_50k.json")), random.Random(2)
    for _ in range(150):
        t = "".join(rnd.choice(["a", "bc ", "   ", "\n", "'re", "<|endoftext|>", "<|end", "é", "12", "中文", "x" * 50, " " * 70]) for _ in range(rnd.randint(0, 200)))
        assert token_count.splice_count(tok, t, rnd.choice([70, 150]), rnd.choice([33, 80])) == len(tok.encode(t, add_special_tokens=False))


def test_byte_bpe(docs, rows, empty):
    path, pattern = byte_bpe.production()
    enc = byte_bpe.encoding_of(path, pattern)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter((i, len(ids := enc.encode_ordinary(t or "")), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())) for i, t, *_ in rows)
    assert bag(byte_bpe.digest_documents(docs, path, pattern, size=50), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    whole = byte_bpe.encode_documents(docs, path, pattern).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in whole) == Counter((i, (t or "").encode()) for i, t, *_ in rows)
    assert byte_bpe.digest_documents(empty, path, pattern).count() == 0


def removed_by_windows(rows, span):
    split = [words(t) for _, t, *_ in rows]
    met = Counter(tuple(w[i : i + span]) for w in split for i in range(len(w) - span + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - span + 1):
            if met[tuple(w[i : i + span])] > 1:
                gone.update(range(i, i + span))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "shard"), [(4096, 40_000), (0, 10), (2, 200)])
def test_substring_dedup(docs, rows, empty, hot, shard):
    make = lambda kept: hashlib.sha256(kept).hexdigest()
    got = substring_dedup._finish(docs, 12, shard, hot, "kept_sha256 string", make)
    assert bag(got, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter((r[0], *x) for r, x in zip(rows, removed_by_windows(rows, 12)))
    assert substring_dedup.dedup_passages(empty).count() == 0


def test_automaton_counts():
    rnd = random.Random(4)
    for _ in range(100):
        seqs = [[rnd.randint(0, 2) for _ in range(rnd.randint(0, 14))] for _ in range(4)]
        weights, machine = [rnd.randint(1, 2) for _ in seqs], substring_dedup.Automaton()
        for s, w in zip(seqs, weights):
            machine.add(s, w)
        machine.finish()
        met = Counter()
        for s, w in zip(seqs, weights):
            for i in range(len(s) - 2):
                met[tuple(s[i : i + 3])] += w
        for s in seqs:
            assert machine.repeated(s, 3) == [i + 3 for i in range(len(s) - 2) if met[tuple(s[i : i + 3])] > 1]


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(docs, rows, empty):
    got = sharding.shard_documents(docs, 8, blocks=7).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in got:
        key = int(hashlib.md5((str(r.doc_id) if r.doc_id is not None else "\0null").encode()).hexdigest()[:16], 16)
        assert (r.shard, r.grown_shard) == (plain_jump(key, 8), plain_jump(key, 9)) and r.grown_shard in (r.shard, 8) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(empty).count() == 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    theirs, ours = con.sql(registry.ORACLE_SQL[name]).df(), registry.QUERIES[name](spark, DATA).toPandas()
    key = sorted(ours.columns)
    assert key == sorted(theirs.columns)
    assert sorted(map(tuple, ours[key].to_numpy().tolist())) == sorted(map(tuple, theirs[key].to_numpy().tolist()))


def test_wavelet_matrix():
    rnd = random.Random(3)
    for top in (1, 2, 9, 300, 49_407, 70_000):
        a = np.array([rnd.randrange(top) for _ in range(rnd.randint(0, 200))], np.uint32)
        w = wavelet.WaveletMatrix(wavelet.pack(a))
        assert (w.ids() == a).all() and [w.access(i) for i in range(len(a))] == a.tolist()
        for token in {*a.tolist()[:10], top}:
            at = [i for i, x in enumerate(a) if x == token]
            assert w.count(token) == len(at) and [w.select(token, k) for k in range(len(at))] == at
            with pytest.raises(IndexError):
                w.select(token, len(at))


def test_wavelet_shards(spark, docs, rows, empty, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = token_count.tokenizer(path)
    wavelet.write_shards(docs, path, str(tmp_path / "w"), shard_ids=700)
    start, want = 0, []
    for i, t in sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert bag(wavelet.read_shards(spark, str(tmp_path / "w")), "doc_id", "start", "n_tokens", "ids_crc32") == Counter(want)
    wavelet.write_shards(empty, path, str(tmp_path / "e"))
    assert wavelet.read_shards(spark, str(tmp_path / "e")).count() == 0


def edit_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(t):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_decontamination_is_exact():
    rnd = random.Random(3)
    for _ in range(25):
        items = [(k, "".join(rnd.choice("abcd é") for _ in range(rnd.randint(1, 50)))) for k in range(5)] + [(9, None), (9, " ")]
        percent = rnd.choice([5, 15, 25])
        b = decontamination.Benchmark(items, rnd.choice([2, 3, 4, 8]), percent)
        texts = [""]
        for _ in range(4):
            x = list(rnd.choice(items[:5])[1])
            for _ in range(rnd.randint(0, 5)):
                x[rnd.randrange(len(x)) :][:1] = [rnd.choice("abcd")]
                x.insert(rnd.randrange(len(x) + 1), rnd.choice("abc")) if rnd.random() < 0.3 else None
            texts.append("".join(rnd.choice("abc 中") for _ in range(30)) + "".join(x) + "abc")
        for t, found in zip(texts, b.regions(texts)):
            n = decontamination.normal(t)
            near = {j: edit_distance(p, n) for j, p in enumerate(b.texts)}
            assert {x[0]: x[3] for x in found} == {j: d for j, d in near.items() if d <= len(b.texts[j]) * percent // 100}


def test_decontamination_in_blocks(spark, docs, empty):
    items = spark.createDataFrame([(1, "alpha"), (2, None), (3, "a b c d e"), (3, "a b c d e")], "item_id long, text string")
    ids = lambda df: {(r.doc_id, tuple(sorted({x.item_id for x in r.regions}))) for r in df.collect()}
    assert ids(decontamination.contaminated_regions(docs, items)) == ids(decontamination.contaminated_regions(docs, items, block_bytes=6))
    assert decontamination.contaminated_regions(empty, items).count() == 0
    assert decontamination.decontaminated(docs, items.limit(0)).count() == docs.count()


def test_near_duplicates(docs, rows, empty):
    sets = []
    for i, t, *_ in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
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
    least = defaultdict(lambda: 1 << 60)
    for k in known:
        least[find(k)] = min(least[find(k)], rows[k][0])
    want = Counter((r[0], len(sets[k]), c := least[find(k)] if r[0] is not None else None, r[0] == c) for k, r in enumerate(rows))
    assert bag(lsh_forest.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want
    assert lsh_forest.near_duplicates(empty).count() == 0


def group_of_copies(n=400, seed=3):
    """Copies of one text, all with as many edits and no hub, where few pairs are similar enough and most are just below."""
    rnd, base = random.Random(seed), [f"b{i}" for i in range(200)]
    out = []
    for i in range(n):
        t, at = list(base), rnd.sample(range(4, 196, 20), 5)
        for k in at:
            t[k] = f"n{i}x{k}"
        out.append((i, " ".join(t)))
    return out


def test_near_duplicates_in_dense_regions(spark):
    rows = group_of_copies()
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if 100 * same >= 75 * (len(sets[i]) + len(sets[j]) - same):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = {i: find(i) for i, _ in rows}
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(set(want.values())) > 1 and got == want


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (98, 99), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {98: 98, 99: 98, 100: 98}


def removed_lines(rows):
    lines = [(i if i is not None else 1 << 62, k, (i, t), frozenset(line.encode().split())) for i, t, *_ in {(r[0], r[1]): r for r in rows}.values() for k, line in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[3]]
    return lines


@pytest.mark.parametrize("keep", [16, 1])
def test_line_dedup(docs, rows, empty, keep):
    lines = removed_lines(rows)
    got = {(r.doc, r.number) for r in line_dedup.removed_lines(line_dedup._rows(docs), keep=keep).select("doc", F.explode("numbers").alias("number")).collect()}
    doubt = lambda i: i >= 1 << 62 or i == 7  # noqa: E731  ids that several texts share are told apart by hashes
    for i, k, _, s in lines:
        if not doubt(i):
            late = any((j, n) < (i, k) and 100 * len(s & o) >= 75 * len(s | o) for j, n, _, o in lines)
            assert ((i, k) in got) == late, (i, k)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows) and line_dedup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("keep", [16, 1])
def test_line_dedup_in_any_order_of_rows(spark, keep):
    """Each set stands in several documents of one batch, the later ones first, and a similar line in a document between."""
    rows = []
    for k in range(40):
        line = [f"w{k}x{i}" for i in range(12)]
        rows += [(900 + k, " ".join(line)), (500 + k, " ".join(line[:-1] + [f"v{k}"])), (100 + k, "own words %d\n%s" % (k, " ".join(line)))]
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {(r.doc, r.number) for r in line_dedup.removed_lines(line_dedup._rows(docs), keep=keep).select("doc", F.explode("numbers").alias("number")).collect()}
    assert got == {(base + k, 0) for base in (500, 900) for k in range(40)}


def test_quality_counts(docs, rows, spark, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    want = Counter()
    for i, t, *_ in rows:
        w, t = words(t), t or ""
        win = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        met, cover = Counter(win), set()
        for k, x in enumerate(win):
            if met[x] > 1:
                cover.update(range(k, k + 8))
        lines = [x for x in t.split("\n") if words(x)]
        failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), failed, not failed)] += 1
    got = quality_rules.quality_rules(docs, labels)
    assert bag(got, "doc_id", *quality_rules.BASE, "base_failed", "kept") == want
    assert quality_rules.quality_rules(empty, labels).count() == 0
    assert quality_rules.filtered(docs, labels.limit(0)).columns == docs.columns


def test_binomial_tail_and_cutoffs(spark):
    from math import comb

    for n, k, p in ((50, 0, 0.02), (400, 3, 0.02), (2000, 1, 0.005), (10, 9, 0.02)):
        want = 1.0 if k > n * p else sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9)
    text = F.when(F.col("id") % 10 == 0, F.expr("repeat('word### ', 2) || array_join(transform(sequence(1, 30), x -> id || '##' || x), ' ')")).otherwise(F.expr("array_join(transform(sequence(1, 30), x -> 'w' || id || 'v' || x), ' ')"))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 10 == 0, 0).otherwise(1).alias("quality"))
    got = {r.doc_id % 10 == 0: r.kept for r in quality_rules.quality_rules(docs, labels).collect()}
    assert got == {True: False, False: True}


def test_quality_model(spark):
    docs, labels = spark.read.parquet(f"{DATA}/../sf0.1/documents.parquet"), spark.read.parquet(f"{DATA}/../sf0.1/labels.parquet")
    scores = quality_model.score(docs, quality_model.fit(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    good = scores.quality == 1
    assert (scores[good].predicted == 1).mean() > 0.98 and (scores[~good].predicted == 0).mean() > 0.85
    again = quality_model.score(docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text")).limit(2), quality_model.fit(docs, labels.limit(0)))
    assert [(r.doc_id, r.score, r.predicted) for r in again.collect()] == [(None, 0.5, 1)] * 2


def test_pipeline(spark, docs, empty):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    for start in (docs, empty):
        left = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, left, DATA).cache()
            assert after.columns == docs.columns, name
            assert after.count() <= left.count()
            left = after
        assert corpus_pipeline.STAGES[-1][1](spark, left, DATA).count() == left.count()
