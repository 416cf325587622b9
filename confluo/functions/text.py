"""Text cleaning as Column expressions; one Arrow function where Spark has no equivalent (composition and transliteration)."""

from __future__ import annotations

import re
import unicodedata
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The words and patterns of the data contract.
LEGAL_SUFFIXES = ["llc", "inc", "incorporated", "corp", "corporation", "ltd", "limited", "pvt", "private", "plc", "pllc", "llp", "lp", "co", "company", "gmbh", "sarl", "sas"]
ADDRESS_ABBREVIATIONS = {"rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard"}
DOMAIN = r"^(https?://)?(www\.)?([a-z0-9]([a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,}(/.*)?$"
STREET_WORDS = [
    "avenue", "street", "road", "drive", "lane", "court", "way", "boulevard", "highway", "place", "terrace", "circle", "parkway", "trail", "square",
    "loop", "pike", "alley", "expressway", "turnpike", "route", "path", "crossing", "crescent", "run", "walk", "row",
    "ave", "st", "rd", "dr", "ln", "ct", "blvd", "hwy", "pl", "ter", "cir", "pkwy", "trl", "sq", "expwy", "tpke", "rt", "rte", "xing", "cres",
    "marg", "rasta", "gali",
]
UNIT_WORDS = ["flat", "plot", "unit", "apt", "apartment", "suite", "ste", "room", "door", "ward", "sector", "sec", "block", "blk", "hn", "no", "shop"]

#: Python's str.isspace, as a Java class.
SPACE = r"(?U)[\s\x1c-\x1f]+"
SYMBOLS = r"[\p{P}\p{S}\x00-\x08\x0e-\x1b\x7f]"
#: The last letter of the Latin blocks that European texts use.
SCAN = 0x24F
#: Latin letters that no decomposition or letter name reduces.
_PLAIN = {"ß": "ss", "ẞ": "ss", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe", "þ": "th", "Þ": "th", "ð": "d", "Ð": "d", "ı": "i", "ĸ": "k", "ŋ": "ng", "Ŋ": "ng", "ſ": "s", "ª": "a", "º": "o", "ĳ": "ij", "Ĳ": "ij"}
#: The usual ASCII for U+0250 to U+02AD, in order.
_PHONETIC = "a a a b o c d d e @ @ e e e e j g g g g u Y h h i i I l l l lZ W W m n n n o OE O F r r r r r r r R R s S j S S t t u U v ^ w y Y z z Z Z ? ? ? C @ B E G H j k L q ? ? dz dZ dz ts tS tC fN ls lz WW ]]".split()
_LETTER = re.compile(r"LATIN (?:SMALL|CAPITAL) (?:LETTER|LIGATURE) ([A-Z]{1,2})(?: WITH .*)?$")


@cache
def latin_to_ascii(ch: str) -> str:
    """A non-ASCII character in ASCII if its name says Latin, else itself: by short lists, by decomposition, or by the letter in its name."""
    name = unicodedata.name(ch, "")
    if "LATIN" not in name:
        return ch
    if ch in _PLAIN:
        return _PLAIN[ch]
    if 0 <= ord(ch) - 0x250 < len(_PHONETIC):
        return _PHONETIC[ord(ch) - 0x250]
    base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
    if base.isascii():
        return base
    m = _LETTER.match(name)
    return m[1].lower() if m else ch


def fold_text(text: str) -> str:
    """NFC, then Latin letters in ASCII; other scripts as they are."""
    if text.isascii():
        return text
    return "".join(c if c < "\x80" else latin_to_ascii(c) for c in unicodedata.normalize("NFC", text))


@F.pandas_udf(StringType())
def _folded(s: pd.Series) -> pd.Series:
    return s.map(fold_text, na_action="ignore")


def blank(c: Column) -> Column:
    """Null as the empty string, the missing value of the contract."""
    return F.coalesce(c, F.lit(""))


def has_non_ascii(c: Column) -> Column:
    return F.octet_length(c) != F.char_length(c)


def fold_latin(c: Column) -> Column:
    """Only text beyond ASCII leaves the JVM."""
    c = blank(c)
    return F.coalesce(_folded(F.when(has_non_ascii(c), c)), c)


def collapse_acronyms(c: Column) -> Column:
    """l.l.c. as llc: dots after single letters before another such letter, white space or the end."""
    return F.regexp_replace(c, r"\b([a-z])\.(?=[a-z]\.|[\p{IsWhite_Space}\x1c-\x1f]|$)", "$1")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def normalize_text(c: Column) -> Column:
    """Lower case, folded, & as and, acronyms closed, apostrophes gone, other punctuation and white space as one space."""
    low = F.replace(fold_latin(F.lower(blank(c))), F.lit("&"), F.lit(" and "))
    bare = F.regexp_replace(collapse_acronyms(low), "['’`]", "")
    return squeeze(F.regexp_replace(bare, SYMBOLS, " "))


def is_domain(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(blank(c), r"(?U)^[\s\x1c-\x1f]+", ""), r"(?U)[\s\x1c-\x1f]+$", "").rlike("(?i)" + DOMAIN)


_SUFFIXED = r"^(\S+(?: \S+)*?)((?: (?:" + "|".join(LEGAL_SUFFIXES) + r"))*)$"


def split_suffix(clean: Column) -> tuple[Column, Column]:
    """The clean name without its trailing legal suffixes (a word is always left), and those."""
    return F.regexp_extract(clean, _SUFFIXED, 1), F.trim(F.regexp_extract(clean, _SUFFIXED, 2))


def any_of(a: Column, words: list[str]) -> Column:
    return F.arrays_overlap(a, F.array(*map(F.lit, words)))


def postal_code(address: Column) -> Column:
    """The 5-6 digits (of any script) of one of the last two words of the last comma part, unless they look like a house or unit number."""
    parts = F.filter(F.transform(F.split(blank(address), ","), squeeze), lambda p: p != "")
    words = F.split(F.try_element_at(parts, F.lit(-1)), " ")

    def tested(tokens: Column, back: int) -> Column:
        t = F.try_element_at(tokens, F.lit(-back))
        at = F.array_position(tokens, t).cast("int")
        letters = F.transform(tokens, lambda w: F.lower(F.regexp_replace(w, "[^A-Za-z]", "")))
        first = F.greatest(at - 2, F.lit(1))
        near = F.concat(F.slice(letters, first, at - first), F.slice(letters, at + 1, F.lit(2)))
        later = F.exists(F.slice(tokens, at + 1, F.size(tokens)), lambda w: w.rlike(r"(?U)\d"))
        earlier = F.slice(letters, F.lit(1), at - 1)
        ok = t.rlike(r"(?U)^\D*\d{5,6}\D*$") & ~any_of(near, STREET_WORDS) & ~later & ~any_of(earlier, UNIT_WORDS)
        return F.when(ok, F.regexp_extract(t, r"(?U)(\d{5,6})", 1))

    return F.coalesce(tested(words, 1), tested(words, 2), F.lit(""))


def expand_address(clean: Column) -> Column:
    return reduce(lambda c, kv: F.regexp_replace(c, rf"\b{kv[0]}\b", kv[1]), ADDRESS_ABBREVIATIONS.items(), clean)


@cache
def non_latin_ranges() -> list[tuple[int, int]]:
    """Letters and marks from 128 up whose name lacks LATIN, read from the Unicode tables."""
    runs: list[tuple[int, int]] = []
    for i in range(128, 0x110000):
        ch = chr(i)
        if unicodedata.category(ch)[0] in "LM" and "LATIN" not in unicodedata.name(ch, ""):
            runs[-1:] = [(runs[-1][0], i)] if runs and runs[-1][1] == i - 1 else [*runs[-1:], (i, i)]
    return runs


def char_class(ranges) -> str:
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]"


@cache
def non_latin_pattern() -> str:
    """One character of those ranges. There are hundreds, so a look ahead at few passes over what is plainly in none: all up to SCAN but the few ranges there."""
    ranges = non_latin_ranges()
    return f"(?={char_class([r for r in ranges if r[1] <= SCAN] + [(SCAN + 1, 0x10FFFF)])}){char_class(ranges)}"


def has_non_latin(c: Column) -> Column:
    c = blank(c)
    return has_non_ascii(c) & c.rlike(non_latin_pattern())


def tokens(clean: Column) -> Column:
    return F.filter(F.split(blank(clean), " "), lambda t: t != "")


def parse_list(c: Column) -> Column:
    """The trimmed, non-blank parts of a comma list; the text nan counts as blank."""
    parts = F.filter(F.transform(F.split(blank(c), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.trim(blank(c)) == "nan", F.array().cast("array<string>")).otherwise(parts)


def truthy(c: Column) -> Column:
    return F.lower(F.trim(blank(c.cast("string")))).isin("true", "1", "t", "yes")
