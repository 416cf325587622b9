"""Checks of packed match and candidate lists. Every rule is a query; a report has a row for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from confluo.sources.tables import invalid_text, read_lines

EXAMPLES = 5
HEADERS = {"matches": ["source1_entity_id", "matched_entity_ids"], "candidates": ["source1_entity_id", "candidate_entity_ids"]}


def check_header(line: str | None, expected: list[str]) -> list[str]:
    """Errors of the first line that stop the check."""
    if line is None or not line:
        return ["empty file"]
    if "\t" not in line and "," in line:
        return ["comma-separated header"]
    if [x.strip().lower() for x in line.split("\t")] != expected:
        return ["unexpected header"]
    return []


def split_lines(lines: DataFrame) -> DataFrame:
    """line, source1_entity_id, ids (untrimmed, blank ones dropped), tabbed: the body's lines that are not blank, split at the first tab."""
    body = lines.where((F.col("line") > 1) & (F.trim("value") != ""))
    at = F.instr("value", "\t")
    rest = F.when(at > 0, F.expr("substring(value, instr(value, '\t') + 1)")).otherwise("")
    ids = F.filter(F.split(rest, ","), lambda x: F.trim(x) != "")
    return body.select("line", F.trim(F.when(at > 0, F.expr("substring(value, 1, instr(value, '\t') - 1)")).otherwise(F.col("value"))).alias("source1_entity_id"), ids.alias("ids"), (at > 0).alias("tabbed"))


def _struct(rule: str, value: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("v"))


def _found(rows: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """rule, v of each row and rule (name, condition, value) that it breaks, in one pass."""
    return rows.select(F.explode(F.array_compact(F.array(*[F.when(broken, _struct(rule, value)) for rule, broken, value in rules]))).alias("x")).select("x.*")


def validate(rows: DataFrame, required: DataFrame, candidates: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """The report on rows of split_lines against the required primary ids; with exploded candidates and known ids if given.

    Of a repeated primary id the last line's list counts. A rule has the number of its distinct offenders and the first EXAMPLES of them.
    """
    ok, key = rows.where("tabbed"), F.col("source1_entity_id")
    own = rows.select("line", "source1_entity_id", "ids", "tabbed", F.explode_outer(F.when(F.col("tabbed") & (F.size("ids") > 0), F.col("ids"))).alias("id"))
    found = _found(own, [
        ("no_tab", ~F.col("tabbed"), F.col("line")),
        ("repeated_id", F.col("tabbed") & (F.size("ids") != F.size(F.array_distinct("ids"))), key),
        ("primary_in_list", F.col("id").startswith("S1-"), key),
        ("unknown_prefix", ~F.col("id").rlike("^S[123]-"), F.col("id")),
    ])
    last = ok.groupBy("source1_entity_id").agg(F.max_by("ids", "line").alias("ids"), F.count("*").alias("times"))
    ids = required.select(F.col("entity_id").alias("source1_entity_id")).distinct().withColumn("wanted", F.lit(True))
    found = found.union(_found(last.join(ids, "source1_entity_id", "full"), [("repeated_row", F.col("times") > 1, key), ("missing", F.col("times").isNull(), key), ("extra", F.col("wanted").isNull(), key)]))
    rules = [(r, "error") for r in ("no_tab", "repeated_row", "repeated_id", "primary_in_list", "unknown_prefix", "missing", "extra")]
    if known is not None:
        other = ok.select(F.explode("ids").alias("entity_id")).where("entity_id RLIKE '^S[23]-'")
        found = found.union(other.join(known.select("entity_id"), "entity_id", "left_anti").select(F.lit("unknown_id"), "entity_id"))
        rules.append(("unknown_id", "error"))
    if candidates is not None:
        pairs = last.select("source1_entity_id", F.explode("ids").alias("id"))
        cand = candidates.select("source1_entity_id", F.col("candidate_entity_id").alias("id"))
        found = found.union(pairs.join(cand, ["source1_entity_id", "id"], "left_anti").select(F.lit("not_a_candidate"), F.concat_ws(":", "source1_entity_id", "id")))
        rules.append(("not_a_candidate", "warning"))
    found = found.distinct()
    first = found.withColumn("k", F.row_number().over(Window.partitionBy("rule").orderBy("v"))).where(F.col("k") <= EXAMPLES)
    first = first.groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("v")), ", ").alias("examples"))
    report = rows.sparkSession.createDataFrame(rules, "rule string, level string").join(found.groupBy("rule").agg(F.count("*").alias("n")).join(first, "rule"), "rule", "left")
    report = report.select("rule", "level", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("examples", F.lit("")).alias("examples"))
    empty = F.size("ids") == 0
    info = ok.agg(F.count("*").alias("rows"), F.count_if(empty).alias("empty_rows"), F.count_if(~empty).alias("full_rows"))
    info = info.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.lit("info").alias("level"), F.col(c).alias("n"), F.lit("").alias("examples")) for c in info.columns])).alias("x")).select("x.*")
    return report.union(info)


def validate_file(spark: SparkSession, path: str, kind: str, required: DataFrame, **more) -> tuple[list[str], DataFrame | None]:
    """Errors that stop the check, or the report."""
    try:
        if invalid_text(spark, path):
            return [f"{path} is not UTF-8 text"], None
        lines = read_lines(spark, path)
        head = lines.where("line = 1").first()
    except Exception as e:  # a missing or unreadable file fails the check
        return [f"cannot read {path}: {type(e).__name__}"], None
    if errors := check_header(head["value"] if head else None, HEADERS[kind]):
        return errors, None
    return [], validate(split_lines(lines), required, **more)


def passed(report: DataFrame) -> bool:
    return report.where("level = 'error' AND n > 0").isEmpty()
