"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read on each worker from a local path (a parameter); nothing
is broadcast.  ``encode`` adds the ids as little-endian unsigned 32-bit
integers in one binary column, ``decode`` turns such a column back into raw
bytes (not text, so ids that end inside a character decode too).

Long texts are split before encoding, at positions that are match boundaries
of the split pattern whatever stands around them:

* a white-space character after another character.  No alternative of the
  pattern crosses from the one to the other, and a match that starts there
  depends only on what follows;
* around a very long white-space run, whose match the library's backtracking
  ``\\s+(?!\\S)`` cannot finish: all of the run but its last character (all of
  it at the end of the text) is one match by definition and is merged as one
  piece.

Cases: a null text encodes as an empty one; an empty text has no ids and
decodes to no bytes; repeated rows give repeated rows; other columns pass
through unless they are named like the output column, which replaces them; an
empty table gives an empty table with the same columns.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm.common import bounded_batches, table

RANK_FILE = "byte_bpe_50k.tiktoken"
CHUNK_CHARS = 50_000
# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BOUNDARY = re.compile(f"(?<=[^{WHITE_SPACE}])(?=[{WHITE_SPACE}])")
_LONG_RUN = re.compile(f"[{WHITE_SPACE}]{{{CHUNK_CHARS},}}")


@functools.lru_cache(maxsize=1)
def encoding(rank_file: str):
    """The encoding of a rank file: an absolute path, or a name that the
    ``public_tokenizers`` package resolves on this machine."""
    import public_tokenizers
    import tiktoken

    path = rank_file if rank_file.startswith("/") else public_tokenizers.path(rank_file)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(rank_file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _split(text: str, start: int, end: int, chunk: int) -> Iterator[str]:
    """``text[start:end]`` in parts of about ``chunk`` characters, cut at safe boundaries."""
    while end - start > chunk:
        cut = _BOUNDARY.search(text, start + chunk, end)
        if cut is None or cut.start() >= end:
            break
        yield text[start:cut.start()]
        start = cut.start()
    if end > start:
        yield text[start:end]


def encode_text(enc, text: str, chunk: int = CHUNK_CHARS, long_run: re.Pattern = _LONG_RUN) -> list[int]:
    """The ids of one text, as the library gives them for the whole text."""
    if len(text) <= chunk:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for run in long_run.finditer(text):
        for part in _split(text, start, run.start(), chunk):
            ids += enc.encode_ordinary(part)
        start = run.end() if run.end() == len(text) else run.end() - 1
        ids += enc._encode_single_piece(text[run.start():start].encode())
    for part in _split(text, start, len(text), chunk):
        ids += enc.encode_ordinary(part)
    return ids


def encode(docs: DataFrame, rank_file: str = RANK_FILE, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the binary column ``out``: the ids of each whole text."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(T.BinaryType())
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file)
        for texts in batches:
            yield pd.Series([np.array(encode_text(enc, t), "<u4").tobytes() for t in texts], dtype=object)

    return docs.withColumn(out, ids_of(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, rank_file: str = RANK_FILE, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the binary column ``out``: the bytes that the ids stand for."""
    bounded_batches(df.sparkSession)

    @F.pandas_udf(T.BinaryType())
    def bytes_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file)
        for packed in batches:
            yield pd.Series([enc.decode_bytes(np.frombuffer(x, "<u4").tolist()) for x in packed], dtype=object)

    return df.withColumn(out, bytes_of(F.coalesce(F.col(ids), F.lit(b""))))


def round_trip(docs: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """Per document: doc_id, n_tokens and the digests of its ids and of the bytes
    they decode to; ``encode`` and ``decode`` in one pass of one Python worker."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("ids binary, decoded binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoding(rank_file)
        for texts in batches:
            ids = [np.array(encode_text(enc, t), "<u4") for t in texts]
            yield pd.DataFrame({"ids": [x.tobytes() for x in ids], "decoded": [enc.decode_bytes(x.tolist()) for x in ids]})

    done = docs.select("doc_id", both(F.coalesce("text", F.lit(""))).alias("both")).select("doc_id", "both.ids", "both.decoded")
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
