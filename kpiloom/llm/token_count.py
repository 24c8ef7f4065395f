"""Token counts of whole texts with a sentencepiece model.

Texts up to ``chunk`` characters are encoded as they are, some at a time.  A
longer text is encoded in chunks that overlap, with the offsets of each piece,
so that no encoder state grows with the text:

* a *proven* boundary is a space after a character that is no space: if no
  piece of the vocabulary holds the space mark after another character, then
  no merge can cross it, and the pieces on either side don't depend on what
  stands on the other;
* two neighbouring chunks are spliced at a proven boundary inside their
  overlap at which both encodings start a piece;
* where an overlap has none, it is doubled; once it would reach the start of
  the chunk, the chunk itself grows to the right.  A text without any such
  boundary ends up encoded whole.

If the vocabulary does not prove the boundary, texts are encoded whole.

Cases: a null text counts as an empty one (0 bytes, 0 tokens); repeated rows
give repeated rows; other columns pass through unless they are named like the
output column, which replaces them; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import bounded_batches, table

MODEL_FILE = "piece_bpe_32k.model"
CHUNK_CHARS = 60_000
OVERLAP_CHARS = 512
LIMIT_TOKENS = 4096
BATCH_CHARS = 1_000_000
SPACE_MARK = "▁"


@functools.lru_cache(maxsize=4)
def processor(model_file: str):
    """The model (absolute path, or a name that ``public_tokenizers``
    resolves) and whether its vocabulary proves boundaries at spaces."""
    import public_tokenizers
    import sentencepiece

    path = model_file if model_file.startswith("/") else public_tokenizers.path(model_file)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    proven = not any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in pieces)
    return sp, proven


def _starts(sp, text: str, begin: int, end: int) -> dict[int, int]:
    """Offset in ``text`` -> index of the piece that starts there, for the
    pieces of ``text[begin:end]`` that hold at least one character; the key -1
    has the number of pieces."""
    offsets = sp.encode(text[begin:end], return_type="offset_mapping")["offsets"]
    out = {-1: len(offsets)}
    for i, (first, after) in enumerate(offsets):
        if after > first:
            out.setdefault(begin + first, i)
    return out


def _splice(text: str, left: dict[int, int], right: dict[int, int], begin: int, end: int) -> int | None:
    """The last proven boundary in ``(begin, end)`` at which both sides start a piece."""
    at = text.rfind(" ", begin + 1, end)
    while at > begin:
        if text[at - 1] not in (" ", SPACE_MARK) and at in left and at in right:
            return at
        at = text.rfind(" ", begin + 1, at)
    return None


def spliced_count(sp, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """The number of pieces of ``text``, from overlapping chunks."""
    begin, end = 0, min(chunk, len(text))
    left, counted_from, total = _starts(sp, text, begin, end), 0, 0
    while end < len(text):
        further = min(end + chunk, len(text))
        width, at = overlap, None
        while at is None and width < end - begin:
            right_begin = end - width
            right = _starts(sp, text, right_begin, further)
            at = _splice(text, left, right, right_begin, end)
            width *= 2
        if at is None:
            left = _starts(sp, text, begin, end := further)
            chunk *= 2
            continue
        total += left[at] - counted_from
        left, counted_from, begin, end = right, right[at], right_begin, further
    return total + left[-1] - counted_from


def counts_of(model_file: str, texts: list[str], chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    sp, proven = processor(model_file)
    out: list[int] = []
    some: list[str] = []
    size = 0

    def flush() -> None:
        nonlocal size
        out.extend(map(len, sp.encode(some, num_threads=1)) if some else ())
        some.clear()
        size = 0

    for text in texts:
        if proven and len(text) > chunk:
            flush()
            out.append(spliced_count(sp, text, chunk, overlap))
            continue
        some.append(text)
        size += len(text)
        if size > BATCH_CHARS:
            flush()
    flush()
    return out


def with_token_count(docs: DataFrame, model_file: str = MODEL_FILE, text: str = "text", out: str = "n_tokens",
                     chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``docs`` with the number of pieces of each whole text."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(counts_of(model_file, list(texts), chunk, overlap), dtype="int64")

    return docs.withColumn(out, count(F.coalesce(F.col(text), F.lit(""))))


def op9_resync_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_count(docs).select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT_TOKENS).alias("over_limit"))
