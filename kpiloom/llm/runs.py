"""Maximal periodic runs of words, found by uniting suffix classes.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends keeping q.  Each Arrow batch is one sequence in which
no two documents share a word number, so its suffixes are sorted together and
classes never mix documents:

* suffixes are ranked by doubling; only suffixes that still share their rank are
  sorted again, so texts without repeats stop after a few rounds;
* neighbours in suffix order have a longest common prefix (LCP), read off the
  rank tables of each round;
* in order of falling LCP, union-find unites the two suffix classes of each
  such pair (Kruskal).  A class keeps its positions in order.  Two positions
  i < j that become neighbours in a class at level LCP have exactly that LCP, so
  if j - i <= LCP they seed the run of period j - i that ends at j + LCP.  The
  seed whose preceding words differ is the run's first word; all others are
  shifts of it and are passed over.  Seeds are taken once all pairs of a level
  are united, so no position of the class lies between the two.

Positions whose neighbours lie between them would have a smaller period, so the
period found is the smallest.  A run of ``min_length`` words or more, and of two
periods or more, has an LCP of at least half ``min_length``; pairs under that
cannot seed one and are not united.

A class is a list of sorted blocks of bounded length, the smaller class is
inserted into the larger: a text of one repeated word costs n log n inserts into
short lists.  One document is handled within one task, a batch of documents is
bounded in bytes; nothing is shuffled.

Cases: a null text counts as empty (no words, no run); a null id plants nothing;
repeated rows give repeated rows; only the named columns are read, so other
columns cannot clash; an empty table gives an empty table with the same columns.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import bounded_batches, table

MIN_LENGTH = 12
BLOCK = 512
RESULT = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs array<struct<start: long, length: long, period: long>>, collapsed string")


class Positions:
    """Distinct numbers in order, as blocks of at most ``2 * BLOCK`` of them."""

    __slots__ = ("blocks", "size")

    def __init__(self, first: int):
        self.blocks, self.size = [[first]], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def _block(self, x: int) -> int:
        """The number of the first block that ends at ``x`` or later, else of the last."""
        blocks, lo, hi = self.blocks, 0, len(self.blocks) - 1
        while lo < hi:
            mid = (lo + hi) // 2
            if blocks[mid][-1] < x:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def after(self, x: int) -> int | None:
        """The smallest number over ``x``."""
        lo = self._block(x + 1)
        at = bisect_left(self.blocks[lo], x + 1)
        return self.blocks[lo][at] if at < len(self.blocks[lo]) else None

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Insert ``x``; the numbers before and after it (None at an end)."""
        blocks, lo = self.blocks, self._block(x)
        block = blocks[lo]
        at = bisect_left(block, x)
        before = block[at - 1] if at else (blocks[lo - 1][-1] if lo else None)
        after = block[at] if at < len(block) else (blocks[lo + 1][0] if lo + 1 < len(blocks) else None)
        insort(block, x)
        self.size += 1
        if len(block) > 2 * BLOCK:
            blocks[lo:lo + 1] = [block[:BLOCK], block[BLOCK:]]
        return before, after


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes of ``symbols`` (numbers from 1) in order, and the ranks by
    their first 1, 2, 4, ... symbols; the last ranks are all different."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.r_[True, np.diff(symbols[order]) != 0]
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
    rank[n] = -1
    ranks, width = [], 1
    while True:
        ranks.append(rank[:n].astype(np.int32))
        shared = np.bincount(rank[:n], minlength=n)[rank[:n]] > 1
        at = np.flatnonzero(shared)
        if not len(at):
            order[rank[:n]] = np.arange(n)
            return order, ranks
        head, tail = rank[at], rank[np.minimum(at + width, n)]
        key = head * (n + 1) + tail + 1
        by = np.argsort(key, kind="stable")
        key, head = key[by], head[by]
        group, part = np.r_[True, np.diff(head) != 0], np.r_[True, np.diff(key) != 0]
        index = np.arange(len(at))
        rank = rank.copy()
        rank[at[by]] = head + index[part][np.cumsum(part) - 1] - index[group][np.cumsum(group) - 1]
        width *= 2


def neighbour_lcp(order: np.ndarray, ranks: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, LCP) of the neighbours in suffix order whose LCP is ``least`` or more."""
    n = len(order)
    level = max(0, least.bit_length() - 1)
    if n < 2 or level >= len(ranks):
        return (np.empty(0, np.int64),) * 3
    same = ranks[level][order[1:]] == ranks[level][order[:-1]]
    i, j = order[:-1][same], order[1:][same]
    lcp = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        a, b = i + lcp, j + lcp
        inside = np.maximum(a, b) < n
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        lcp += (inside & (ranks[k][a] == ranks[k][b])) << k
    enough = lcp >= least
    return i[enough], j[enough], lcp[enough]


def find_runs(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``min_length`` symbols or
    more and of two periods or more, by start, then period."""
    if len(symbols) < 2:
        return []
    order, ranks = suffix_order(symbols)
    left, right, lcps = neighbour_lcp(order, ranks, max(1, (min_length + 1) // 2))
    falling = np.argsort(-lcps, kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}
    values, out = symbols.tolist(), []

    def root(x: int) -> int:
        if x not in parent:
            parent[x], members[x] = x, Positions(x)
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    seeds: list[tuple[int, int]] = []
    level = -1

    def seed(i: int, j: int) -> None:
        if j - i <= level and j - i + level >= min_length and (i == 0 or values[i - 1] != values[j - 1]):
            seeds.append((i, j))

    def end_level() -> None:
        # once a level's classes are complete, what stands between two seeds shows
        out.extend((i, j - i + level, j - i) for i, j in seeds if members[root(i)].after(i) == j)
        seeds.clear()

    for i, j, lcp in zip(left[falling].tolist(), right[falling].tolist(), lcps[falling].tolist()):
        if lcp != level:
            end_level()
            level = lcp
        small, large = root(i), root(j)
        if members[small].size > members[large].size:
            small, large = large, small
        parent[small] = large
        into, moved = members[large], members.pop(small)
        united = set(moved) if moved.size > 1 else ()
        for x in moved:
            before, after = into.add(x)
            # a neighbour that came along with x was its neighbour before
            if before is not None and before not in united:
                seed(before, x)
            if after is not None and after not in united:
                seed(x, after)
    end_level()
    return sorted(set(out), key=lambda run: (run[0], run[2]))


def planted(doc_id: object, n: int) -> tuple[int, int] | None:
    """(a, p) where the words from a on repeat with period p, or None: fixed by the id alone."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def runs_of_batch(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words: one suffix order for all of them."""
    numbers: dict[bytes, int] = {}
    parts, starts, used = [], [0], 0
    for words in texts:
        numbers.clear()
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.int64, len(words)) + used)
        used += len(numbers)
        starts.append(starts[-1] + len(words))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if starts[-1]:
        begin = np.array(starts)
        runs = find_runs(np.concatenate(parts), min_length)
        owner = np.searchsorted(begin, [r[0] for r in runs], "right") - 1
        for (start, length, period), at in zip(runs, owner.tolist()):
            found[at].append((start - starts[at], length, period))
    return found


def with_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
              plant: bool = False) -> DataFrame:
    """Per row: the id, the number of runs, the longest run (ties: smallest
    start, then period), every run, and the text without the words that a run
    holds after its first period.  ``plant`` first makes the words of some ids
    periodic (``planted``), so that every table holds runs."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            words = [t.encode().split() for t in texts]
            if plant:
                for k, (one, some) in enumerate(zip(ids, words)):
                    if at := planted(one, len(some)):
                        a, p = at
                        words[k] = (some[:a + p] + some[a:a + p] * ((len(some) - a) // p))[:len(some)]
            rows = []
            for some, runs in zip(words, runs_of_batch(words, min_length)):
                best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
                start, length, period = best or (None,) * 3
                rows.append((len(runs), start, length, period, 1000 * length // period if best else None,
                             [dict(zip(("start", "length", "period"), r)) for r in runs], _collapsed(some, runs).decode()))
            out = pd.DataFrame(rows, columns=["n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"])
            yield out.astype({c: "Int64" for c in ("start", "length", "period", "exponent_milli")} | {"n_runs": "int64"})

    one = F.col(doc_id)
    return docs.select(one, found(one.cast("string"), F.coalesce(F.col(text), F.lit(""))).alias("_found")).select(doc_id, "_found.*")


def op13_suffix_class_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_runs(table(spark, sf_dir, "documents"), plant=True)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
