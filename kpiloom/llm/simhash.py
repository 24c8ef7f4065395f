"""SimHash near-duplicates, compared on vertical bit planes.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``SHINGLE`` words joined by a space, repeats included (fewer words: the whole
sequence); a bit is set if it is set in over half of the shingles' XXH64 (seed
42).  A text without words has fingerprint zero, which is linked like any
other.  Two fingerprints link at ``RADIUS`` or fewer differing bits.

1. Fingerprints are computed in one narrow stage and written once; everything
   after works on distinct fingerprints, whose rows may all lack an id, so
   exact copies cost nothing; a group is named by its smallest doc_id at the end.
2. Candidates by pigeonhole: the 64 bits are cut into ``blocks`` parts; two
   fingerprints within the radius agree on ``blocks - RADIUS`` parts at least,
   so every choice of that many parts makes a table, and the pair meets in a
   bucket of one.  The number of fingerprints decides how many bits a bucket
   needs to hold about ``BUCKET`` of them (the first bits of the chosen parts
   where fewer suffice, more parts and tables where more are needed).
   Whatever the choice, no pair is missed.
3. A bucket over ``SPLIT`` rows is split into sub-blocks that are compared two
   by two, each two in a group of their own, so no task holds a large bucket.
4. Within a group the comparison is bit-sliced: plane b holds bit b of all
   fingerprints, 64 to a word.  A fingerprint's distances to 64 others are
   updated together, plane by plane, by carry-save addition into three words
   of counter bits; words whose 64 distances have all passed the radius are
   abandoned.  A group returns a spanning forest of its links, not its pairs.
5. Components come from alternating large-star and small-star steps on the
   links, each a grouped minimum and a join, written to the shared folder
   every round.

Cases: a null text has no words; a row with a null doc_id links like any
other and takes the component of its group, null where no document of the
group has an id; rows that share a doc_id count as one document with
several texts; repeated rows are returned as often as they come; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.bloom import left_out
from kpiloom.llm.common import bounded_batches, spare_prefix, table, written

SHINGLE = 4
RADIUS = 4
BITS = 64
BUCKET = 256
SPLIT = 1024
HASH_SEED = 42
PART_WORDS = 50_000
ABANDON_EVERY = 8


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text.  Long texts are hashed in parts, so memory
    is bounded by the words and one part's bits."""
    import xxhash

    words = text.encode().lower().split()  # ASCII case and white space only
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    hash_ = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, "int64")
    for at in range(0, n, PART_WORDS):
        h = np.array([hash_(joined[a:b], HASH_SEED) for a, b in zip(starts[at:at + PART_WORDS].tolist(), last[at:at + PART_WORDS].tolist())], "<u8")
        ones += np.unpackbits(h.view("uint8").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="int64")
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with its fingerprint as a (signed) long."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], "uint64").view("int64"))

    return docs.withColumn(out, of(F.coalesce(F.col(text), F.lit(""))))


def tables_for(rows: int, radius: int = RADIUS, bucket: int = BUCKET) -> list[int]:
    """Bit masks, one a table: fingerprints within the radius agree on all
    bits of at least one of them."""
    needed = max(0, ceil(log2(max(1, rows) / bucket)))
    blocks = radius + 1
    while blocks < BITS and BITS * (blocks - radius) // blocks < needed:
        blocks += 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        bits = [b for i in chosen for b in range(edges[i], edges[i + 1])]
        masks.append(sum(1 << b for b in bits[:needed]))
    return sorted(set(masks))


def planes_of(fps: np.ndarray) -> np.ndarray:
    """BITS x words: plane b, word w holds bit b of the fingerprints 64w .. 64w + 63."""
    words = -(-len(fps) // 64)
    padded = np.zeros(words * 64, "<u8")
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view("uint8").reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(queries: np.ndarray, planes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(query, column word, lanes) as flat arrays: for the words of ``planes``
    that hold a fingerprint within the radius of a query, which 64-bit lanes do.

    Three counter words a (query, word) pair hold a distance up to 7, a fourth
    says that it has passed the radius (at most 7)."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    shape = (len(queries), planes.shape[1])
    at = np.arange(shape[0] * shape[1])
    c0, c1, c2, over = (np.zeros(len(at), "<u8") for _ in range(4))
    row, col = np.divmod(at, shape[1])
    for b in range(BITS):
        flip = np.where((queries >> np.uint64(b)) & np.uint64(1), full, np.uint64(0))
        x = planes[b][col] ^ flip[row]
        carry = c0 & x
        c0 ^= x
        x = c1 & carry
        c1 ^= carry
        over |= c2 & x
        c2 ^= x
        if b % ABANDON_EVERY == ABANDON_EVERY - 1:
            passed = over | _above(c0, c1, c2, radius)
            live = passed != full
            if not live.all():
                c0, c1, c2, over, row, col = (v[live] for v in (c0, c1, c2, passed, row, col))
            else:
                over = passed
            if not len(row):
                break
    lanes = ~over
    return np.stack([row, col]), lanes


def _above(c0: np.ndarray, c1: np.ndarray, c2: np.ndarray, radius: int) -> np.ndarray:
    """The lanes whose counter is over the radius."""
    out = np.zeros_like(c0)
    for value in range(radius + 1, 8):
        term = np.full_like(c0, 0xFFFFFFFFFFFFFFFF)
        for bit, c in enumerate((c0, c1, c2)):
            term &= c if value >> bit & 1 else ~c
        out |= term
    return out


def links_of(left: np.ndarray, right: np.ndarray, radius: int = RADIUS, block: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of positions with left[i] and right[j] within the radius, a block of queries at a time."""
    planes = planes_of(right)
    for first in range(0, len(left), block):
        (row, col), lanes = within(left[first:first + block], planes, radius)
        if not len(row):
            continue
        hit = np.unpackbits(lanes.astype("<u8").view("uint8").reshape(-1, 8), axis=1, bitorder="little")
        k, lane = np.nonzero(hit)
        i, j = row[k] + first, col[k] * 64 + lane
        real = j < len(right)
        yield i[real], j[real]


def forest_of(fps: np.ndarray, ids: np.ndarray, side: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a group's links.  ``side``: 0 and 1 for
    the two sub-blocks to compare with each other, or all 0 for one block."""
    parent = np.arange(len(fps))
    cross = bool(side.any())
    a, b = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(len(fps)),) * 2
    for i, j in links_of(fps[a], fps[b], radius):
        x, y = a[i], b[j]
        new = parent[x] != parent[y]
        x, y = x[new], y[new]
        while len(x):  # hook the larger root under the smaller, then flatten, until no link joins two trees
            low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
            np.minimum.at(parent, high, low)
            while (parent[parent] != parent).any():
                parent = parent[parent]
            new = parent[x] != parent[y]
            x, y = x[new], y[new]
    child = np.flatnonzero(parent != np.arange(len(fps)))
    return ids[child], ids[parent[child]]


def links(nodes: DataFrame, rows: int, radius: int = RADIUS, bucket: int = BUCKET, split: int = SPLIT) -> DataFrame:
    """Edges (a, b) between the ids of ``nodes`` (id, fp) whose components are
    those of all links within the radius."""
    masks = tables_for(rows, radius, bucket)
    keyed = nodes.withColumn("mask", F.explode(F.array(*(F.lit(m - (1 << BITS) if m >> 63 else m).cast("long") for m in masks)))) \
        .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    large = (keyed.groupBy("mask", "key").count().filter(F.col("count") > split)
             .select("mask", "key", F.ceil(F.col("count") / split).cast("int").alias("parts")))
    spread = keyed.join(large, ["mask", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    spread = spread.withColumn("part", F.pmod(F.xxhash64("fp", "id", F.lit(1)), F.col("parts")).cast("int"))
    spread = (spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("id", "fp", "mask", "key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
                      (F.col("part") > F.col("other")).cast("int").alias("side")))

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy("int64").view("uint64")
        a, b = forest_of(fps, group["id"].to_numpy("int64"), group["side"].to_numpy(), radius) if len(fps) > 1 else (fps[:0],) * 2
        return pd.DataFrame({"a": a.astype("int64"), "b": b.astype("int64")})

    return spread.groupBy("mask", "key", "p", "q").applyInPandas(forest, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id on an edge.

    Large star: each node joins its larger neighbours to its smallest.  Small
    star: each node joins its smaller neighbours and itself to its smallest.
    Both keep components; once nothing changes every tree is a star."""
    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    current = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = written(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct(), "edges")
        low = least(large)
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        current = written(small, "edges")
        state = current.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(state) == before:
            return current.select(F.col("u").alias("id"), F.col("v").alias("component")) \
                .unionByName(current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before = tuple(state)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
                    bucket: int = BUCKET, split: int = SPLIT) -> DataFrame:
    """doc_id, fp (long) and component_id of every row of ``docs``."""
    prints, labels = _grouped(docs, doc_id, text, shingle, radius, bucket, split)
    return prints.join(labels, "fp", "left").select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
             bucket: int = BUCKET, split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and of every fingerprint its group (the
    smallest fingerprint) and component_id (the smallest doc_id, null where the
    group has none)."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = written(fingerprints(own, "text", "fp", shingle).select("doc_id", "fp"), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "fingerprint-nodes")
    keyed = nodes.select(F.col("fp").alias("id"), "fp")
    found = components(same_document(prints).unionByName(links(keyed, nodes.count(), radius, bucket, split)))
    linked = nodes.join(found.withColumnRenamed("id", "fp"), "fp")
    least = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    linked = linked.join(least, "component").select("fp", "component", "component_id")
    labels = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("group"), F.coalesce("component_id", "id").alias("component_id"))
    return prints, written(labels, "fingerprint-groups")


def same_document(prints: DataFrame) -> DataFrame:
    """Links between the fingerprints that come with one doc_id and the smallest of them."""
    several = prints.filter("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low != high")
    return prints.join(several, "doc_id").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose group has a smaller doc_id; of
    several rows with one id that stays, the one with the first text does.  A
    row without an id goes if its group has a document with one; a group
    without any id keeps one row, that with the first text."""
    prints, labels = _grouped(docs)
    found = prints.filter("doc_id is not null").join(labels, "fp")
    dropped = written(found.filter("doc_id != component_id").select("doc_id").distinct(), "near-duplicates")
    kept = left_out(docs.filter("doc_id is not null"), dropped, {"doc_id": F.col("doc_id")})
    repeated = found.filter("doc_id = component_id").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.head(1):
        one = _first(kept.join(repeated, "doc_id", "left_semi"), "doc_id", docs.columns)
        kept = kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(one)
    if not prints.filter("doc_id is null").head(1):
        return kept
    own = spare_prefix(docs.columns)
    fp, group = f"{own}fp", f"{own}group"
    groups = labels.filter("component_id is null").select(F.col("fp").alias(fp), F.col("group").alias(group))
    lone = fingerprints(docs.filter("doc_id is null"), "text", fp).join(groups, fp).select(*docs.columns, group)
    return kept.unionByName(_first(lone, group, docs.columns))


def _first(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row a key: the first by its text, then by the other columns."""
    first = Window.partitionBy(key).orderBy("text", *(c for c in columns if c not in ("doc_id", "text")))
    n = f"{spare_prefix(columns)}n"
    return rows.withColumn(n, F.row_number().over(first)).filter(f"{n} = 1").select(columns)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op7_bitsliced_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")
