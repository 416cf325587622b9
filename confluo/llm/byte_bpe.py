"""Byte-level BPE encoding and decoding with a local rank file.

Texts longer than SEGMENT characters are cut at safe boundaries before they are encoded: places
where every match of the splitting pattern ends whatever surrounds it, so the ids of the parts
joined are the ids of the whole. These are a non-space before ASCII white space, and an ASCII
letter, digit or mark (other than an apostrophe) before one of another kind. A piece without any
such place stays whole. Decoding joins raw bytes, so an id sequence need not be valid UTF-8.

Null texts count as empty: no ids, and the hash of no bytes. Nulls in other columns and repeated
rows pass through.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm.common import documents, map_arrow

SEGMENT = 65_536
#: No apostrophe: it may begin a contraction that holds the letters after it.
_SAFE = re.compile(r"(?<=[!-~])(?=[ \t\n\r])|(?<=[A-Za-z])(?=[0-9!-&(-/:-@\[-`{-~])|(?<=[0-9])(?=[A-Za-z!-&(-/:-@\[-`{-~])|(?<=[!-&(-/:-@\[-`{-~])(?=[A-Za-z0-9])")
_loaded: dict[str, object] = {}


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoding_of(path: str, pattern: str):
    if path not in _loaded:
        import tiktoken

        _loaded[path] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})
    return _loaded[path]


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """The text in parts of about size characters, cut at safe boundaries only."""
    out, start = [], 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def encode(enc, text: str, size: int = SEGMENT) -> np.ndarray:
    """The ids of a text as unsigned 32-bit integers."""
    ids = [x for part in segments(text, size) for x in enc.encode_ordinary(part)] if len(text) > size else enc.encode_ordinary(text)
    return np.array(ids, "<u4")


def decode(enc, ids: np.ndarray) -> bytes:
    return enc.decode_bytes(ids.tolist())


def encode_documents(docs: DataFrame, path: str, pattern: str, size: int = SEGMENT, extra: tuple[str, ...] = ()) -> DataFrame:
    """docs' doc_id and extra columns, with ids (binary, little-endian unsigned 32-bit) and the bytes that decoding them gives back."""
    kinds = dict(docs.dtypes)

    def work(batch):
        enc = encoding_of(path, pattern)
        ids = [encode(enc, t, size) for t in batch.column("text").to_pylist()]
        yield {c: batch.column(c) for c in ("doc_id", *extra)} | {"ids": [x.tobytes() for x in ids], "decoded": [decode(enc, x) for x in ids]}

    rows = docs.select("doc_id", *extra, F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(rows, work, ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *extra)) + ", ids binary, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, size: int = SEGMENT) -> DataFrame:
    """encode_documents with digests in place of ids and bytes, made before they leave the worker."""

    def work(batch):
        enc = encoding_of(path, pattern)
        n, a, b = [], [], []
        for t in batch.column("text").to_pylist():
            ids = encode(enc, t, size)
            n.append(len(ids))
            a.append(hashlib.sha256(ids.tobytes()).hexdigest())
            b.append(hashlib.sha256(decode(enc, ids)).hexdigest())
        yield {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(rows, work, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def production() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(documents(spark, sf_dir), *production())
