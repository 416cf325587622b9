import random
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from confluo.functions import similarity as s
from confluo.functions import text as t


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize(("raw", "clean"), [
    ("  ACME   Corp. ", "acme corp"), ("Café & Söhne", "cafe and sohne"), ("L.L.C.", "llc"), ("O'Neil’s", "oneils"), ("Straße", "strasse"), (None, ""), ("", ""),
    ("Łódź-Œuvre", "lodz oeuvre"), ("दिल्ली, x", "दिल्ली x"), ("état", "etat"), ("a b", "a b"),
])
def test_normalize(spark, raw, clean):
    assert one(spark, t.normalize_text, raw) == clean


def test_acronyms(spark):
    assert one(spark, t.collapse_acronyms, "l.l.c. u.s.a l.p.") == "llc us.a lp"


@pytest.mark.parametrize(("clean", "name", "suffix"), [("acme co llc", "acme", "co llc"), ("llc co", "llc", "co"), ("llc", "llc", ""), ("", "", ""), ("co acme", "co acme", "")])
def test_suffix(spark, clean, name, suffix):
    assert one(spark, lambda c: F.array(*t.split_suffix(c)), clean) == [name, suffix]


@pytest.mark.parametrize(("address", "code"), [("12 Road, Paris 75001", "75001"), ("12345 Road", ""), ("Flat No 00403", ""), ("X, Delhi-110001 India", "110001"), ("", ""), (None, ""), (" , ", ""), ("a 12345 6", ""), ("b, 1234567", "")])
def test_postal(spark, address, code):
    assert one(spark, t.postal_code, address) == code


@pytest.mark.parametrize(("name", "is_domain"), [("https://www.a-b.com/x y", True), (" acme.co ", True), ("acme corp", False), ("a.b", False), (None, False)])
def test_domain(spark, name, is_domain):
    assert one(spark, t.is_domain, name) is is_domain


def test_non_latin_over_all_characters(spark):
    chars = [chr(i) for i in range(1, sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF]
    want = {c for c in chars if ord(c) >= 128 and unicodedata.category(c)[0] in "LM" and "LATIN" not in unicodedata.name(c, "")}
    df = spark.range(1, sys.maxunicode + 1, numPartitions=8).where("id < 55296 OR id > 57343").select("id", F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    got = {chr(r.id) for r in df.where(t.has_non_latin(F.col("c"))).collect()}
    assert got == want


def test_lists(spark):
    assert one(spark, t.parse_list, " S2-1, ,S3-10 ,") == ["S2-1", "S3-10"]
    assert one(spark, t.parse_list, "nan") == []
    assert one(spark, t.parse_list, None) == []


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_subsequence():
    assert s.common_subsequences(["kitten", "", "a"], ["sitting", "x", "a"]).tolist() == [4, 0, 1]
    rnd = random.Random(1)
    pairs = [["".join(rnd.choice("abcé中") for _ in range(rnd.choice([0, 1, 7, 20, 63, 64, 65, 130, 200]))) for _ in range(400)] for _ in "ab"]
    want = [plain_lcs(a, b) for a, b in zip(*pairs)]
    assert s.common_subsequences(*pairs).tolist() == s.common_subsequences(*pairs[::-1]).tolist() == want
    s.CELLS, cells = 3000, s.CELLS
    assert s.common_subsequences(*pairs).tolist() == want
    s.CELLS = cells


def test_similarities(spark):
    assert one(spark, s.gram_jaccard, "acme corp", "acme co") == pytest.approx(5 / 7)
    assert one(spark, s.gram_jaccard, "ab", "ab") == 1
    assert one(spark, s.token_sort_ratio, "b a", "a b") == 1
    assert one(spark, s.token_set_ratio, "a b c", "a b") == 1
    assert one(spark, s.token_set_ratio, "ab cd", "ab ce") == pytest.approx(max(2 * 4 / 10, 1 - 3 / 7))
    assert one(spark, s.token_set_ratio, "", "a") == 0
    assert one(spark, s.three_state, "", "a") == -1
    assert one(spark, s.three_state, " A", "a ") == 1
