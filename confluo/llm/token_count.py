"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text of up to CHUNK characters is encoded at once. A longer one is cut into chunks that
overlap; each is encoded alone, with offsets. Two neighbours are spliced at a position where
both have a boundary between pre-tokens (or beside a special token). The pre-tokeniser reads
from left to right and looks only a few characters ahead, so from a common boundary on both
go on alike: the splice is proven, except within MARGIN characters of a chunk's cut end, which
are not used. Where no common boundary exists the overlap is doubled and the pair is encoded
again, up to the rest of the text, so the counts are always those of the whole text.

Null and empty texts have no bytes and no tokens. Repeated rows and null ids pass through.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm.common import documents, map_arrow, utf8

CHUNK, OVERLAP, LIMIT = 32_768, 512, 512
#: Characters beside a cut that prove nothing: the longest special token and three characters of look-ahead.
MARGIN = 32
_loaded: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once in each worker, on one thread."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "false", "1"
        from tokenizers import Tokenizer

        _loaded[path] = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
    return _loaded[path]


def boundaries(encoding, base: int) -> dict[int, int]:
    """Position in the text -> tokens before it, for each position between two pre-tokens or at a special token."""
    out, last = {}, object()
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word is None or word != last:
            out[base + start] = i
        last = object() if word is None else word
    return out


def splice_count(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of the whole text, from overlapping chunks."""
    total, start, done = 0, 0, 0  # done: tokens of the current chunk that earlier chunks have counted
    stop = min(len(text), chunk)
    left = tok.encode(text[:stop], add_special_tokens=False)
    while stop < len(text):
        wide = overlap
        while True:
            begin = max(start, stop - wide)
            end = min(len(text), stop + max(chunk, stop - start))
            right = tok.encode(text[begin:end], add_special_tokens=False)
            have, new = boundaries(left, start), boundaries(right, begin)
            at = max((p for p in have.keys() & new.keys() if begin + (MARGIN if begin else 0) <= p <= stop - MARGIN and have[p] >= done), default=None)
            if at is not None:
                total += have[at] - done
                done = new[at]
                break
            if begin == start:  # the overlap is the whole chunk: it grows to the right instead
                at, begin = None, start
                right = tok.encode(text[start:end], add_special_tokens=False)
                break
            wide *= 2
        left, start, stop = right, begin, end
    return total + len(left) - done


def count_tokens(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; the tokenizer's defaults hold for special strings."""

    def work(batch):
        tok = tokenizer(path)
        texts = batch.column("text").to_pylist()
        counts: list = [None] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= chunk]
        for i, e in zip(short, tok.encode_batch_fast([texts[i] for i in short], add_special_tokens=False)):
            counts[i] = len(e)
        for i, t in enumerate(texts):
            if counts[i] is None:
                counts[i] = splice_count(tok, t, chunk, overlap)
        yield {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": counts, "over_limit": [c > limit for c in counts]}

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.octet_length(utf8()).cast("long").alias("n_bytes"))
    return map_arrow(rows, work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
