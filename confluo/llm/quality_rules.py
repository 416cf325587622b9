"""Quality rules whose cutoffs are certified on labelled holdouts. DataFrame functions only.

Six signals of a text (each: higher is worse, a whole number per thousand, or a mean length in
hundredths) are compared with cutoffs of a grid fixed in advance. The rules are not fitted, so all
labelled rows are a holdout. For every stratum (lang; null is a stratum of its own), rule and cutoff
the false rejections k among n rows labelled good are counted; the cutoff is certified if the exact
(Clopper-Pearson) upper bound on the rejection rate is at most ALPHA / rules, that is if
P(Bin(n, ALPHA / rules) <= k) <= DELTA / (strata * rules * cutoffs), a Bonferroni correction over all
tests. So with probability 1 - DELTA no stratum loses more than ALPHA of its good rows to the rules
together. Among certified cutoffs the one with the largest gain, rejected bad rows less COST times
rejected good rows, is used; a rule without a positive gain is off in that stratum.

Null texts have no words: all counts 0 and base_failed. Rows without a label, repeated labels, null
ids and empty label tables are allowed; with no labels nothing beyond base_failed is rejected. A
doc_id labelled more than once counts once, as good if any label says so. Repeated rows are judged alike;
an empty table gives an empty result. Texts are taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from confluo.llm.common import documents, written

SPACE = r"[\x20\x09-\x0D]+"
ALPHA, DELTA, COST = 0.03, 0.05, 10
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SHARES = [5, 10, 20, 30, 50, 75, 100, 150, 200, 300, 400, 500, 600, 700, 800, 900]
LENGTHS = [600, 700, 800, 900, 1000, 1100, 1200, 1300, 1400, 1600, 1800, 2000, 2500, 3000, 4000, 5000]
RULES = {"symbols": SHARES, "dup_lines": SHARES, "repeats": SHARES, "marks": SHARES, "capitals": SHARES, "word_length": LENGTHS}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(h: Column) -> Column:
    """Words covered by windows whose hash is found twice or more, from the windows' hashes in order."""
    pairs = lambda h: F.array_sort(F.transform(h, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    near = lambda s, x, at: F.coalesce(F.get(s, at)["v"] == x["v"], F.lit(False))
    twice = lambda s: F.filter(s, lambda x, i: near(s, x, i - 1) | near(s, x, i + 1))
    once = lambda c, f: F.transform(F.array(c), f)[0]  # noqa: E731  c is computed once, though f names it often
    places = once(pairs(h), lambda s: F.array_sort(F.transform(twice(s), lambda x: x["i"])))
    width = lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(once(places, width)).cast("long")


def signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with _q, a struct of the base counts and rule signals of each whole text."""
    t, kept = F.coalesce(F.col(text), F.lit("")), docs.columns
    gone = lambda c, pattern: (F.char_length(c) - F.char_length(F.regexp_replace(c, pattern, ""))).cast("long")
    df = docs.withColumn("_w", F.array_remove(F.split(t, SPACE), ""))
    df = df.withColumns({"_h": F.when(F.size("_w") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("_w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_w", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")), "_l": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), "_j": F.array_join("_w", "")})
    df = df.withColumn("_q", F.struct(
        F.size("_w").cast("long").alias("n_words"), F.char_length("_j").cast("long").alias("word_chars"), gone(F.col("_j"), r"[#*$%&|<>]+").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), _repeat_words(F.col("_h")).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"), gone(F.col("_j"), "!+").alias("n_marks"), gone(F.col("_j"), r"[A-ZÀ-Þ]+").alias("n_capitals"),
    ))
    return df.select(*kept, "_q")


def values(q: Column) -> dict[str, Column]:
    """The rules' signals from the counts; 0 where there is nothing to divide by."""
    share = lambda a, b, by=1000: F.when(q[b] > 0, F.floor(by * q[a] / q[b])).otherwise(0).cast("long")
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"), "marks": share("n_marks", "word_chars"), "capitals": share("n_capitals", "word_chars"), "word_length": share("word_chars", "n_words", 100)}


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed in logarithms; 1 where k > n * p, as it is then far above any level used."""
    from math import log, log1p

    def step(s: Column, i: Column) -> Column:
        term = s["t"] + F.log((n - i + 1).cast("double") / i) + F.lit(log(p) - log1p(-p))
        return F.struct(term.alias("t"), (F.greatest(s["all"], term) + F.log1p(F.exp(-F.abs(s["all"] - term)))).alias("all"))

    first = n * F.lit(log1p(-p))
    total = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), F.struct(first.alias("t"), first.alias("all")), step, lambda s: F.exp(s["all"]))
    return F.when(k > n * F.lit(p), 1.0).otherwise(total)


def certified(rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, cost: int = COST) -> DataFrame:
    """stratum, cutoffs (map of rule -> cutoff) from rows (doc_id, stratum, _q) and labels (doc_id, quality)."""
    good = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("_good"))

    def below(grid: list[int], v: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, grid)), lambda c: c < v)).alias("bucket")

    rules = F.array(*[F.struct(F.lit(r).alias("rule"), below(grid, v)) for (r, grid), v in zip(RULES.items(), values(F.col("_q")).values())])
    # Rows that the base rejects are not the rules' to judge. A doc_id that several rows hold counts once, by the least of them: the bound needs independent rows.
    held = rows.where(~base_failed(F.col("_q"))).join(good, "doc_id").groupBy("doc_id").agg(F.min(F.struct("stratum", "_q", "_good")).alias("x")).select("x.*")
    held = held.select("stratum", "_good", F.explode(rules).alias("r"))
    counts = held.groupBy("stratum", "r.rule", "r.bucket").agg(F.count_if(F.col("_good") == 1).alias("good"), F.count_if(F.col("_good") != 1).alias("bad"))
    grid = F.create_map(*[x for r, g in RULES.items() for x in (F.lit(r), F.array(*map(F.lit, g)))])
    # One row for each stratum and rule: buckets are at most as many as cutoffs, and one.
    table = counts.groupBy("stratum", "rule").agg(F.collect_list(F.struct("bucket", "good", "bad")).alias("b"))
    above = lambda i, what: F.aggregate(F.filter("b", lambda x: x["bucket"] > i), F.lit(0).cast("long"), lambda a, x: a + x[what])
    all_good = F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + x["good"])
    tests = table.select("stratum", "rule", all_good.alias("n"), F.posexplode(grid[F.col("rule")]).alias("i", "cutoff"), "b").select("stratum", "rule", "n", "cutoff", above(F.col("i"), "good").alias("k"), above(F.col("i"), "bad").alias("caught"))
    m = F.size(F.collect_set("stratum").over(Window.partitionBy(F.lit(0)))) * sum(map(len, RULES.values()))
    tests = tests.withColumns({"level": F.lit(delta) / m, "tail": binomial_tail(F.col("n"), F.col("k"), alpha / len(RULES)), "gain": F.col("caught") - cost * F.col("k")})
    best = tests.where((F.col("tail") <= F.col("level")) & (F.col("gain") > 0)).groupBy("stratum", "rule").agg(F.max(F.struct("gain", "cutoff"))["cutoff"].alias("cutoff"))
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def judged(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """rows with base_failed and kept."""
    own = F.col("_q")
    over = F.lit(False)
    for r, v in values(own).items():
        over = over | F.coalesce(v > F.col("cutoffs")[r], F.lit(False))
    # A table whose size Spark knows: where it is small, as strata mostly are few, the rows are not shuffled.
    out = rows.join(written(cutoffs, "cutoffs"), "stratum", "left")
    return out.withColumns({"base_failed": base_failed(own), "kept": ~(base_failed(own) | over)}).drop("cutoffs")


def stratum() -> Column:
    return F.coalesce(F.col("lang"), F.lit("")).alias("stratum")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept for each row."""
    rows = written(signals(docs.select("doc_id", stratum(), "text")).select("doc_id", "stratum", "_q"), "quality")
    return judged(rows, certified(rows, labels)).select("doc_id", *[F.col("_q")[c].alias(c) for c in BASE], "base_failed", "kept")


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with docs' columns."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), "doc_id", stratum(), "text")
    rows = written(signals(packed).select("_row", "doc_id", "stratum", "_q"), "quality")
    return judged(rows, certified(rows.select("doc_id", "stratum", "_q"), labels)).where("kept").select("_row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
