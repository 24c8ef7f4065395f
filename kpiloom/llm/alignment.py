"""Alignment of two tokenizations of the same text, by merge-path partitioning.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a
sentencepiece model.  Both tokenizations cover the same bytes (a space, then
the text), so aligning them is merging their two sorted lists of token ends:

* every step of the merge (an end of A, of B, or of both) closes one overlap of
  an A token with a B token: a link;
* an end that both have closes a group, a smallest cut in which both agree.

*Merge path.*  A diagonal of the merge grid (so many ends consumed) is found by
a binary search over both lists; diagonals ``piece`` apart cut the merge into
pieces of equal work that need nothing from each other but one token beyond
their right border.  Texts of one piece are merged where they are encoded.
The pieces of longer ones are rows of their own, dealt over all tasks, and a
group that reaches over borders is stitched from the pieces' ends.  Inside a
piece the merge is two vectorised searches.

*Corpus counts.*  A document's links are stored as distinct (pair, count), so
exploding and summing them is a partial aggregation.  The totals are told back
by ``skew.looked_up``: frequent pairs by a bounded broadcast, all others by a
shuffle without hot keys.  The maximum per B id is bounded by B's vocabulary.

Texts are encoded in chunks cut at a space after another character, where no
match of A's pattern and, as B's vocabulary proves, no piece of B crosses.

Cases: null and empty texts, and those whose joined tokens differ from the space
and the text, have no tokens: zeros and ''; equal rows and rows without an id
count as rows of their own; only the named columns are read, so other columns
cannot clash; an empty table gives an empty table with the same columns.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.byte_bpe import encode_text
from kpiloom.llm.common import bounded_batches, table, written
from kpiloom.llm.skew import looked_up
from kpiloom.llm.token_count import SPACE_MARK, processor

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_CHARS = 50_000
PIECE_STEPS = 1 << 16
# a pair is one int: the A id times this, plus the B id
B_IDS = 1 << 15
MOST_IDS = 1 << 16

SLICE = "struct<piece: int, a: binary, b: binary, own_a: int, own_b: int, a_from: long, b_from: long>"
ENCODED = f"n_a long, n_b long, n_groups long, n_links long, pairs array<int>, counts array<int>, digest string, slices array<{SLICE}>"
MERGED = "n_groups long, n_links long, pairs array<int>, counts array<int>, head_a binary, head_b binary, body binary, tail_a binary, tail_b binary"


def _resolved(name: str) -> str:
    import public_tokenizers

    return name if name.startswith("/") else public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """Letter of the byte-level alphabet -> byte: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def tokenizer_a(name: str):
    """The encoding of a byte-level BPE file and the bytes of its ids.  Where ids
    follow the order of merges, merging by rank is merging by id."""
    import public_tokenizers
    import tiktoken

    with open(_resolved(name), encoding="utf-8") as lines:
        file = json.load(lines)
    vocab, merges = file["model"]["vocab"], file["model"]["merges"]
    made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
    if file["model"]["type"] != "BPE" or file["normalizer"] or any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError(f"{name}: not a byte-level BPE file whose ids follow its merges")
    if max(vocab.values()) >= MOST_IDS:
        raise ValueError(f"{name}: a pair of ids is over an int")
    letters, special = _byte_letters(), {t["id"] for t in file["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if i not in special}
    tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), tokens


@functools.lru_cache(maxsize=2)
def tokens_b(name: str) -> list[bytes]:
    """The bytes of each id of a sentencepiece model."""
    sp, _ = processor(name)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if len(pieces) > B_IDS:
        raise ValueError(f"{name}: over {B_IDS} ids")
    return [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]


@functools.lru_cache(maxsize=4)
def _widths(name: str, side: str) -> np.ndarray:
    tokens = tokenizer_a(name)[1] if side == "a" else tokens_b(name)
    return np.array([len(t) for t in tokens], np.int64)


@functools.lru_cache(maxsize=1)
def _decimals() -> np.ndarray:
    """The ids followed by a comma, a bar and a semicolon, at 3 * id, 3 * id + 1 and
    3 * id + 2: eight bytes each, filled up with zeros."""
    return np.frombuffer(b"".join((b"%d%c" % (i, c)).ljust(8, b"\0") for i in range(MOST_IDS) for c in b",|;"), np.uint64)


def chunks(full: str, size: int) -> Iterator[str]:
    """``full`` (a space, then the text) in parts of ``size`` characters or more that each start with a space."""
    start = 0
    while len(full) - start > size:
        at = full.find(" ", start + size)
        while at > 0 and (full[at - 1].isspace() or full[at - 1] == SPACE_MARK):
            at = full.find(" ", at + 1)
        if at < 0 or at == len(full) - 1:
            break
        yield full[start:at]
        start = at
    yield full[start:]


def encode_both(text: str, a_file: str = A_FILE, b_file: str = B_FILE, chunk: int = CHUNK_CHARS) -> tuple[np.ndarray, np.ndarray] | None:
    """The ids of A and of B, or None if either doesn't give the bytes of the space and the text."""
    if not text:
        return None
    (enc, _), (sp, proven), b_bytes = tokenizer_a(a_file), processor(b_file), tokens_b(b_file)
    full = " " + text
    parts = list(chunks(full, chunk if proven else len(full)))
    # A's merges only ever join bytes of the text, B's normalizer may change them
    b = [i for part in parts for i in sp.encode(part[1:])] if len(parts) > 1 else sp.encode(text)
    if b"".join([b_bytes[i] for i in b]) != full.encode():
        return None
    a = [enc.encode_to_numpy(part) if len(part) <= chunk else np.array(encode_text(enc, part, chunk), np.uint32) for part in parts]
    return np.concatenate(a).astype(np.int32), np.array(b, np.int32)


def diagonal(a_ends: np.ndarray, b_ends: np.ndarray, steps: int) -> tuple[int, int]:
    """How many ends of A and of B the first ``steps`` steps of the merge take;
    an end that both have is A's first, and never parted from B's."""
    low, high = max(0, steps - len(b_ends)), min(steps, len(a_ends))
    while low < high:
        mid = (low + high) // 2
        if a_ends[mid] <= b_ends[steps - mid - 1]:
            low = mid + 1
        else:
            high = mid
    i, j = low, steps - low
    return i, j + int(0 < i and j < len(b_ends) and a_ends[i - 1] == b_ends[j])


def slices(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, steps: int) -> list[dict]:
    """The merge in pieces of ``steps`` steps: each has its own tokens and one more of either side."""
    total = len(a) + len(b)
    cuts = [(0, 0), *(diagonal(a_ends, b_ends, d) for d in range(steps, total, steps)), (len(a), len(b))]
    return [{"piece": k, "a": a[i:i2 + 1].tobytes(), "b": b[j:j2 + 1].tobytes(), "own_a": i2 - i, "own_b": j2 - j,
             "a_from": int(a_ends[i - 1]) if i else 0, "b_from": int(b_ends[j - 1]) if j else 0}
            for k, ((i, j), (i2, j2)) in enumerate(zip(cuts, cuts[1:]))]


def groups_text(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, groups: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3`` of whole groups, numbered from 0."""
    if not groups:
        return b""
    number = np.arange(groups)
    a_through, b_through = np.searchsorted(a_group, number, "right"), np.searchsorted(b_group, number, "right")
    a_code, b_code = 3 * a, 3 * b
    a_code[a_through - 1] += 1
    b_code[b_through - 1] += 2
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + np.r_[0, b_through][a_group]] = a_code
    out[np.arange(len(b)) + a_through[b_group]] = b_code
    text = _decimals()[out].view(np.uint8)
    return text[text != 0].tobytes()[:-1]


def merged(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, own_a: int, own_b: int) -> dict:
    """One piece: its links as distinct pairs, the ids before its first common
    end (head), its whole groups (body), and the ids after its last (tail)."""
    a_own, b_own = a_ends[:own_a], b_ends[:own_b]
    ends = np.concatenate([a_own, b_own])
    ends.sort(kind="stable")   # two sorted runs: one merge
    first = np.r_[True, ends[1:] != ends[:-1]][:len(ends)]
    steps, common = ends[first], ends[~first]
    pairs, counts = np.unique(a[np.searchsorted(a_ends, steps)] * np.int32(B_IDS) + b[np.searchsorted(b_ends, steps)], return_counts=True)
    a_group, b_group = np.searchsorted(common, a_own), np.searchsorted(common, b_own)
    n = len(common)
    a, b = a[:own_a].astype(np.int64), b[:own_b].astype(np.int64)
    a_cut, b_cut = np.searchsorted(a_group, [1, max(n, 1)]), np.searchsorted(b_group, [1, max(n, 1)])
    ids = lambda x: ",".join(map(str, x.tolist())).encode()
    return {"n_groups": n, "n_links": len(steps), "pairs": pairs, "counts": counts.astype(np.int32),
            "head_a": ids(a[:a_cut[0]]), "head_b": ids(b[:b_cut[0]]),
            "body": groups_text(a[a_cut[0]:a_cut[1]], a_group[a_cut[0]:a_cut[1]] - 1, b[b_cut[0]:b_cut[1]], b_group[b_cut[0]:b_cut[1]] - 1, max(n - 1, 0)),
            "tail_a": ids(a[a_cut[1]:]), "tail_b": ids(b[b_cut[1]:])}


def stitched(pieces: list[dict]) -> str:
    """The groups of a text from its pieces in order: what one leaves open at its end belongs to the head of the next."""
    done: list[bytes] = []
    open_a: list[bytes] = []
    open_b: list[bytes] = []
    for p in pieces:
        open_a += [p["head_a"]] if p["head_a"] else []
        open_b += [p["head_b"]] if p["head_b"] else []
        if p["n_groups"]:
            done += [b",".join(open_a) + b"|" + b",".join(open_b), *([p["body"]] if p["body"] else [])]
            open_a, open_b = [p["tail_a"]] if p["tail_a"] else [], [p["tail_b"]] if p["tail_b"] else []
    return b";".join(done).decode()


def _encoded_text(text: str, a_file: str, b_file: str, chunk: int, steps: int) -> dict:
    both = encode_both(text, a_file, b_file, chunk)
    none = np.empty(0, np.int32)
    if both is None:
        return {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "pairs": none, "counts": none, "digest": "", "slices": []}
    a, b = both
    a_ends, b_ends = _widths(a_file, "a")[a].cumsum(), _widths(b_file, "b")[b].cumsum()
    out = {"n_a": len(a), "n_b": len(b), "n_groups": 0, "n_links": 0, "pairs": none, "counts": none, "digest": None, "slices": []}
    if len(a) + len(b) > steps:
        return out | {"slices": slices(a, b, a_ends, b_ends, steps)}
    whole = merged(a, b, a_ends, b_ends, len(a), len(b))
    return out | {k: whole[k] for k in ("n_groups", "n_links", "pairs", "counts")} | {"digest": hashlib.sha256(stitched([whole]).encode()).hexdigest()}


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_file: str = A_FILE, b_file: str = B_FILE,
            chunk: int = CHUNK_CHARS, steps: int = PIECE_STEPS) -> DataFrame:
    """Per row of ``docs``: its id, token counts and, for texts of one piece, the merge; else the pieces to merge."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(ENCODED)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([_encoded_text(t, a_file, b_file, chunk, steps) for t in texts],
                               columns=["n_a", "n_b", "n_groups", "n_links", "pairs", "counts", "digest", "slices"])

    return docs.select(F.col(doc_id).alias("doc_id"), encode(F.coalesce(F.col(text), F.lit(""))).alias("_e")).select("doc_id", "_e.*")


def merged_pieces(tokens: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """(_row, piece, merge of the piece) of the texts of several pieces, dealt over the tasks."""
    @F.pandas_udf(MERGED)
    def merge(a: pd.Series, b: pd.Series, own_a: pd.Series, own_b: pd.Series, a_from: pd.Series, b_from: pd.Series) -> pd.DataFrame:
        out = []
        for x, y, n, m, begin_a, begin_b in zip(a, b, own_a, own_b, a_from, b_from):
            x, y = np.frombuffer(x, np.int32), np.frombuffer(y, np.int32)
            out.append(merged(x, y, begin_a + _widths(a_file, "a")[x].cumsum(), begin_b + _widths(b_file, "b")[y].cumsum(), n, m))
        return pd.DataFrame(out, columns=["n_groups", "n_links", "pairs", "counts", "head_a", "head_b", "body", "tail_a", "tail_b"])

    pieces = tokens.select("_row", F.inline("slices")).repartition("_row", "piece")
    return pieces.select("_row", "piece", merge("a", "b", "own_a", "own_b", "a_from", "b_from").alias("_m")).select("_row", "piece", "_m.*")


def stitched_texts(pieces: DataFrame) -> DataFrame:
    """(_row, n_groups, n_links, digest) of the texts of several pieces."""
    @F.pandas_udf("string")
    def digest(parts: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(stitched(list(p)).encode()).hexdigest() for p in parts])

    part = F.struct("piece", "n_groups", "head_a", "head_b", "body", "tail_a", "tail_b")
    return (pieces.groupBy("_row").agg(F.sum("n_groups").alias("n_groups"), F.sum("n_links").alias("n_links"), F.sort_array(F.collect_list(part)).alias("_p"))
            .select("_row", "n_groups", "n_links", digest("_p").alias("digest")))


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_file: str = A_FILE, b_file: str = B_FILE,
            chunk: int = CHUNK_CHARS, steps: int = PIECE_STEPS) -> tuple[DataFrame, DataFrame]:
    """(documents, links).  documents: _row (its own number), doc_id, n_a, n_b,
    n_groups, n_links, digest of the groups; links: _row, pair, n.  Both read
    written tables."""
    tokens = written(encoded(docs, doc_id, text, a_file, b_file, chunk, steps).withColumn("_row", F.monotonically_increasing_id()), "alignment-tokens")
    several = F.size("slices") > 0
    pieces = written(merged_pieces(tokens.filter(several), a_file, b_file), "alignment-pieces")
    columns = ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "digest"]
    long = tokens.filter(several).select("_row", "doc_id", "n_a", "n_b").join(stitched_texts(pieces), "_row")
    documents = tokens.filter(~several).select(columns).unionByName(long.select(columns))
    pair = F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n")))
    links = tokens.select("_row", pair.alias("pair", "n")).unionByName(pieces.select("_row", pair.alias("pair", "n")))
    return documents, links


def pair_totals(links: DataFrame) -> DataFrame:
    """(pair, total, best): the links of a pair in the corpus, and whether no pair of its B id has more."""
    counts = written(links.groupBy("pair").agg(F.sum("n").alias("total")), "alignment-counts")
    b_id = (F.col("pair") % B_IDS).alias("b_id")
    most = counts.groupBy(b_id).agg(F.max("total").alias("most"))  # at most one row an id of B
    return counts.select("pair", "total", b_id).join(F.broadcast(most), "b_id").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def op12_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, links = aligned(table(spark, sf_dir, "documents"))
    totals = written(pair_totals(links), "alignment-totals")
    sums = (looked_up(links, totals, "pair", "total").groupBy("_row")
            .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")))
    of_row = F.coalesce(F.col("n_best"), F.lit(0)).cast("long").alias("n_best"), F.coalesce(F.col("count_sum"), F.lit(0)).cast("long").alias("count_sum")
    return documents.join(sums, "_row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *of_row, F.col("digest").alias("groups_sha256"))
