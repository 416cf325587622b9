"""Registered queries take all that the operators and the documented fixture take."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from confluo.operators import blocking
from confluo.plans import fixture
from confluo.plans.catalogue import QUERIES

DATA = "/root/testdata/sf0.001"


def test_lists_hold_every_candidate(spark):
    want = QUERIES["candidate_topk"](spark, DATA).select("s1", "cand").toPandas()
    got = QUERIES["explode_pairs"](spark, DATA).toPandas()
    assert want.groupby("s1").size().max() > 10
    assert set(map(tuple, got.to_numpy())) == set(map(tuple, want.to_numpy()))
    assert blocking.PER_SOURCE == 50


def test_records_take_the_documented_characters(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) > 240").select("doc_id", "text")
    rows = fixture.records(spark, DATA).withColumn("doc_id", F.expr("cast(split_part(entity_id, '-', 2) AS bigint)")).join(docs, "doc_id").collect()
    assert rows
    for r in rows:
        assert r.business_name.startswith(r.text[:80].replace("\n", " "))
        assert r.business_address.startswith(r.text[80:240].replace("\n", " "))


def test_classifier_sees_every_posting(spark, tmp_path, monkeypatch):
    """A word that over a thousand records of S2 have still brings the records of S3 that have it: no cap cuts its postings."""
    monkeypatch.setattr(blocking, "FLOOR", 10_000)
    ids = [k for k in range(3300) if k % 3 == 1 or k in (0, 6, 12) or k % 3 == 2 and k < 180]
    texts = [f"acme u{k}".ljust(80) + f"v{k}" for k in ids]
    (tmp_path / "t").mkdir()
    pq.write_table(pa.table({"doc_id": ids, "text": texts, "lang": ["en"] * len(ids)}), tmp_path / "t" / "documents.parquet")
    assert sum(k % 3 == 1 for k in ids) > blocking.POSTING_CAP
    got = {(r[0], r[1]) for r in QUERIES["gbt_scores"](spark, str(tmp_path / "t")).collect()}
    ranked = {k: sorted((f"S{k + 1}-{i}" for i in ids if i % 3 == k))[:50] for k in (1, 2)}
    want = {(f"S1-{i}", c) for i in ids if i % 3 == 0 for c in ranked[1] + ranked[2]}
    assert got == want, (sorted(got - want)[:5], sorted(want - got)[:5])
