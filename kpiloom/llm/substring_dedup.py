"""Removal of repeated passages: exact counts of all windows of ``window``
words, by super-k-mer partitioning.

A window's minimiser is the smallest hash among its ``m``-word sequences
(leftmost if equal).  Consecutive windows whose minimiser is the same occurrence
form a super-k-mer: one packed string of at most ``2 * window - m`` words that
goes to the bucket of the minimiser's value.  Equal windows have equal
minimisers, so a bucket sees every copy of its windows; there the windows are
sorted and equal neighbours counted, by their words, not by hashes.

1. Minimisers are counted (partial sums, then one shuffle of 16 bytes a
   super-k-mer).  Two equal windows belong to two super-k-mers, so one whose
   minimiser occurs once holds no repeated window.  A Bloom filter of the others
   (at most ``MAX_BLOCKS`` blocks of 64 bytes, however large the corpus) lets
   nearly all such super-k-mers stay behind; false positives only cost work.
2. The super-k-mers that pass are written as packed strings, and dealt by
   minimiser.  A bucket is one sorted stretch of a task's rows.
3. Hot minimisers, those with over 1 / ``HOT_MINIMISERS`` of all super-k-mers (so
   fewer than that, and broadcast), don't go to a bucket: their distinct packed
   strings are summed map-side, cut into windows, and the windows' 128-bit digests
   are counted by a partial aggregation; ``skew.looked_up`` tells the totals back.
4. Each text's repeated windows meet its text by the text's 128-bit digest, so
   equal texts share the work.  Texts that a Bloom filter shows to have none stay
   where they are.  A very frequent text is repeated whole (its windows start
   again in its copies), so it needs no join either.

Windows are judged on the input, and the first occurrence goes like all others.

Cases: a null text has no words; a text under ``window`` words keeps all of them
even if its copies abound; repeated rows are occurrences of their own and give a
row each; only the named columns are read, so other columns cannot clash; an
empty table gives an empty table with the same columns.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.bloom import probed
from kpiloom.llm.common import bounded_batches, table, written
from kpiloom.llm.skew import HEAVY_KEYS, looked_up

WINDOW = 35
MINIMISER_WORDS = 8
SLICE_CHARS = 1_000_000
MAX_BLOCKS = 1 << 19
KEYS_PER_BLOCK = 32
HOT_MINIMISERS = 1 << 20
LEAST_HOT = 2_000
LEAST_HEAVY = 1_000
# a field of 6 bits in each of the 8 words of a block; the block is taken from the lowest bits
_FIELDS = [16 + 6 * i for i in range(8)]

SUPER_K_MER = "text_id binary, start long, windows int, minimiser long, packed binary, packed_id binary, n long"


def super_k_mers(docs: list[list[bytes]], window: int = WINDOW, m: int = MINIMISER_WORDS) -> tuple[np.ndarray, ...]:
    """(doc, start, windows, minimiser) of the super-k-mers of lists of words."""
    sizes = np.array([len(d) for d in docs], np.int64)
    total = int(sizes.sum())
    if total < window:
        return (np.empty(0, np.int64),) * 4
    word = np.fromiter((zlib.crc32(w) for d in docs for w in d), np.uint64, total)
    value = np.zeros(total - m + 1, np.uint64)
    for k in range(m):
        value = value * np.uint64(0x9E3779B97F4A7C15) + word[k:total - m + 1 + k]
    for shift in (31, 29):
        value ^= value >> np.uint64(shift)
        value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    span, reach = window - m + 1, 1
    least, at = value, np.arange(len(value))
    while reach < span:  # the least of the next ``reach`` values becomes that of twice as many, or of ``span``
        step = min(reach, span - reach)
        later = least[step:] < least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, least[step:], least[:-step])
        reach += step
    owner = np.repeat(np.arange(len(docs)), sizes)
    starts = np.flatnonzero(owner[:total - window + 1] == owner[window - 1:])
    if not len(starts):
        return (np.empty(0, np.int64),) * 4
    at = at[starts]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    doc = owner[starts[first]]
    return doc, starts[first] - (np.cumsum(sizes) - sizes)[doc], np.diff(np.r_[first, len(starts)]), value[at[first]].view(np.int64)


def _slices(texts: list[str]) -> Iterator[slice]:
    """Consecutive texts of ``SLICE_CHARS`` together, or one longer text."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE_CHARS:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def _words(texts: Iterable[str]) -> list[list[bytes]]:
    return [t.encode().split() for t in texts]


def repeated_minimisers(docs: DataFrame, window: int = WINDOW, m: int = MINIMISER_WORDS) -> DataFrame:
    """The minimisers of two or more super-k-mers of the column ``text``."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for some in _slices(texts):
                values, n = np.unique(super_k_mers(_words(texts[some]), window, m)[3], return_counts=True)
                yield pd.DataFrame({"minimiser": values, "n": n})

    counts = docs.select("text").mapInPandas(count, "minimiser long, n long")
    return counts.groupBy("minimiser").agg(F.sum("n").alias("n")).filter("n > 1").select("minimiser")


def minimiser_filter(keys: DataFrame, max_blocks: int = MAX_BLOCKS) -> np.ndarray:
    """Bloom filter of the minimisers: one row of 8 words a block, at most ``max_blocks``."""
    blocks = 1 << max(0, min(max_blocks.bit_length() - 1, (keys.count() // KEYS_PER_BLOCK).bit_length()))
    key = F.col("minimiser")
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(key, f).bitwiseAND(F.lit(63)).cast("int")) for f in _FIELDS]
    rows = (keys.select(key.bitwiseAND(F.lit(blocks - 1)).alias("block"), *(b.alias(f"w{i}") for i, b in enumerate(bits)))
            .groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)))).toPandas()
    words = np.zeros((blocks, 8), np.int64)
    words[rows["block"].to_numpy(np.int64)] = rows[[f"w{i}" for i in range(8)]].to_numpy(np.int64)
    return words


def possible(words: np.ndarray, minimisers: np.ndarray) -> np.ndarray:
    block = words[minimisers & (len(words) - 1)]
    field = (minimisers[:, None].view(np.uint64) >> np.array(_FIELDS, np.uint64)) & np.uint64(63)
    return ((block.view(np.uint64) >> field) & np.uint64(1)).all(axis=1)


def packed_super_k_mers(docs: DataFrame, keep: Broadcast, window: int = WINDOW, m: int = MINIMISER_WORDS) -> DataFrame:
    """The super-k-mers of (text_id, text) whose minimiser passes the filter;
    copies of a text within an Arrow batch are one row with their number ``n``."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            distinct = batch.groupby("text_id", sort=False)["text"].agg(["first", "size"])
            texts = distinct["first"].tolist()
            for some in _slices(texts):
                ids, sizes, words = distinct.index[some].tolist(), distinct["size"].iloc[some].tolist(), _words(texts[some])
                found = super_k_mers(words, window, m)
                passed = possible(keep.value, found[3])
                rows = []
                for doc, start, windows, minimiser in zip(*(x[passed].tolist() for x in found)):
                    packed = b" ".join(words[doc][start:start + windows + window - 1])
                    rows.append((ids[doc], start, windows, minimiser, packed, hashlib.blake2b(packed, digest_size=16).digest(), sizes[doc]))
                yield pd.DataFrame(rows, columns=["text_id", "start", "windows", "minimiser", "packed", "packed_id", "n"])

    return docs.select("text_id", "text").mapInPandas(pack, SUPER_K_MER)


def windows_of(packed: bytes, window: int) -> list[bytes]:
    """The windows of a packed string, in order."""
    ends = list(accumulate(len(w) + 1 for w in packed.split(b" ")))
    return [packed[begin:end - 1] for begin, end in zip([0, *ends], ends[window - 1:])]


def bucket_flags(rows: list[tuple[bytes, int]], window: int) -> dict[bytes, int]:
    """(packed string, occurrences) of one bucket -> a bit for each of its windows that occurs twice or more."""
    number: dict[bytes, int] = {}
    for packed, n in rows:
        number[packed] = number.get(packed, 0) + n
    if len(number) == 1:
        packed, n = next(iter(number.items()))
        return {packed: (1 << len(windows_of(packed, window))) - 1 if n > 1 else 0}
    flags = dict.fromkeys(number, 0)
    ordered = sorted((w, packed, bit) for packed in number for bit, w in enumerate(windows_of(packed, window)))
    for _, same in groupby(ordered, itemgetter(0)):
        held = list(same)
        if len(held) > 1 or number[held[0][1]] > 1:
            for _, packed, bit in held:
                flags[packed] |= 1 << bit
    return flags


def bucket_covers(rows: DataFrame, window: int) -> DataFrame:
    """(text_id, start, flags) of super-k-mers whose buckets are of bounded size:
    one stretch of a sorted partition each."""
    def covers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flagged(buckets: pd.DataFrame) -> pd.DataFrame:
            out = set()
            columns = (buckets[c].tolist() for c in ("minimiser", "packed", "n", "text_id", "start"))
            for _, same in groupby(zip(*columns), itemgetter(0)):
                bucket = list(same)
                flags = bucket_flags([(packed, n) for _, packed, n, _, _ in bucket], window)
                out.update((text_id, start, flags[packed]) for _, packed, _, text_id, start in bucket if flags[packed])
            return pd.DataFrame(list(out), columns=["text_id", "start", "flags"])

        left: pd.DataFrame | None = None
        for batch in batches:
            batch = batch if left is None else pd.concat([left, batch])
            ended = batch["minimiser"] != batch["minimiser"].iloc[-1] if len(batch) else []
            left = batch[~ended] if len(batch) else batch
            if len(batch) > len(left):
                yield flagged(batch[ended])
        if left is not None and len(left):
            yield flagged(left)

    columns = ["minimiser", "packed", "n", "text_id", "start"]
    return (rows.select(columns).repartition("minimiser").sortWithinPartitions("minimiser")
            .mapInPandas(covers, "text_id binary, start long, flags long"))


def hot_covers(rows: DataFrame, window: int) -> DataFrame:
    """(text_id, start, flags) of the super-k-mers of hot minimisers: windows counted by digest."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(hashlib.blake2b(w, digest_size=16).digest(), i, bit, n)
                   for i, packed, n in zip(batch["packed_id"], batch["packed"], batch["n"]) for bit, w in enumerate(windows_of(packed, window))]
            yield pd.DataFrame(out, columns=["window_id", "packed_id", "bit", "n"])

    packed = written(rows.groupBy("packed_id", "packed").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")), "substring-hot")
    windows = written(packed.select("packed_id", "packed", "n").mapInPandas(cut, "window_id binary, packed_id binary, bit int, n long"), "substring-hot-windows")
    totals = written(windows.groupBy("window_id").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows")).filter("total > 1"), "substring-hot-totals")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    flags = looked_up(windows.select("window_id", "packed_id", "bit"), totals, "window_id", "rows").groupBy("packed_id").agg(F.bit_or(bit).alias("flags"))
    flags = written(flags.join(packed.select("packed_id", "rows"), "packed_id"), "substring-hot-flags")
    places = rows.select("packed_id", "text_id", "start").distinct()
    return looked_up(places, flags, "packed_id", "rows").select("text_id", "start", "flags")


def repeated_windows(docs: DataFrame, window: int = WINDOW, m: int = MINIMISER_WORDS, least_hot: int = LEAST_HOT,
                     hot_minimisers: int = HOT_MINIMISERS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(text_id, covers) of the texts of (text_id, text) that hold a repeated
    window: the starts of their super-k-mers, each with a bit a repeated window."""
    spark = docs.sparkSession
    if not m <= window <= m + 61:
        raise ValueError("flags of a super-k-mer are the bits of a long")
    repeated = written(repeated_minimisers(docs, window, m), "substring-minimisers")
    keep = spark.sparkContext.broadcast(minimiser_filter(repeated, max_blocks))
    rows = written(packed_super_k_mers(docs, keep, window, m), "substring-super-k-mers")
    sizes = written(rows.groupBy("minimiser").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > least_hot), "substring-buckets")
    hot = sizes.filter(F.col("rows") > rows.count() // hot_minimisers).select("minimiser")
    cold = rows.join(F.broadcast(hot), "minimiser", "left_anti")
    covers = bucket_covers(cold, window)
    if not hot.isEmpty():
        covers = covers.unionByName(hot_covers(rows.join(F.broadcast(hot), "minimiser", "left_semi"), window))
    return covers.groupBy("text_id").agg(F.collect_set(F.struct("start", "flags")).alias("covers"))


def _kept(words: list[bytes], covers: Iterable[dict] | None, all_of_it: bool, window: int) -> tuple[int, int, str]:
    n = len(words)
    if n < window or covers is None and not all_of_it:
        return n, 0, b" ".join(words).decode()
    if all_of_it:
        return n, n, ""
    step = np.zeros(n + 1, np.int64)
    start = np.array([c["start"] for c in covers], np.int64)
    flags = np.array([c["flags"] for c in covers], np.int64)
    for bit in range(int(flags.max()).bit_length()):
        at = start[(flags >> bit) & 1 == 1] + bit
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
    kept = np.flatnonzero(np.cumsum(step[:n]) == 0)
    return n, n - len(kept), b" ".join([words[i] for i in kept.tolist()]).decode()


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, m: int = MINIMISER_WORDS,
                    least_heavy: int = LEAST_HEAVY, **limits: int) -> DataFrame:
    """Per row of ``docs``: the id, n_words, n_removed and the kept words (one
    space between them) after the removal of every word that a repeated window covers."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def kept(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, covers, whole in batches:
            rows = [_kept(t.encode().split(), c, a, window) for t, c, a in zip(texts, covers, whole)]
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.substring(F.unhex(F.sha2(body.cast("binary"), 256)), 1, 16).alias("text_id"))
    covers = written(repeated_windows(own.select("text_id", "text"), window, m, **limits), "substring-covers")
    copies = own.groupBy("text_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least_heavy)
    frequent = copies.filter(F.col("n") > docs.count() // HEAVY_KEYS).select("text_id", F.lit(True).alias("whole"))  # under HEAVY_KEYS rows
    known = own.join(F.broadcast(written(frequent, "substring-frequent")), "text_id", "left")
    known = probed(known, covers.select("text_id"), "text_id").withColumn("apart", F.col("_possible") & F.col("whole").isNull())
    none = F.lit(None).cast("array<struct<start:long,flags:long>>").alias("covers")
    result = F.col("doc_id"), kept("text", "covers", F.coalesce("whole", F.lit(False))).alias("r")
    here = known.filter("not apart").select("doc_id", "text", "whole", none).select(*result)
    met = known.filter("apart").join(covers, "text_id", "left").select("doc_id", "text", "whole", "covers").select(*result)
    return here.unionByName(met).select(F.col("doc_id").alias(doc_id), "r.*")


def op11_super_k_mer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
