"""Approximate nearest neighbours by cosine: multi-index hashing.

1. Codes.  A rotation is learned on at most ``SAMPLE`` vectors (seeded order
   of their ids): principal axes, then alternating quantization, which turns
   the axes so that the signs lose least.  The sign of each rotated component
   is a bit.
2. Radius.  On the same sample, exact neighbours are compared with Hamming
   distances, and the smallest radius that would keep ``TARGET`` of the
   neighbours is taken.  Neighbours in the whole table are nearer than in a
   sample of it, so the radius errs on the wide side.
3. Index.  A code is split into substrings of ``SUB_BITS`` bits and stands in
   one bucket for each of them.  By the pigeonhole principle a code within the
   radius of a query agrees with it, in at least one substring, up to
   ``radius // substrings`` bits (one less for all but the first ``radius %
   substrings + 1``); the query probes all buckets so near.  Every code within
   the radius is met, and the first substring that meets it reports it.
4. In a bucket, full codes are compared; those within the radius are reranked
   with the original vectors in double precision.  A bucket returns at most
   ``k`` candidates a query, so no list of pairs is shuffled.
5. Where the tables stand depends on the radius alone (``buckets_met``).  While
   a query probes less than one bucket in 2 ** SUB_BITS over all substrings
   together, rows are shuffled by (substring, bucket) and only probed buckets
   see a query.  Beyond that a row would meet a query more than once, and eight
   copies of each vector would travel for it; rows then go once into parts,
   each with the tables of its own rows, and query blocks visit the parts.
   Both ways find the same rows.
6. Large buckets, on either side, are split: index rows and probes are dealt
   into parts by hash and every two parts meet in a group of their own, so no
   group holds more than about ``PART`` of either, whatever the skew.  Copies
   of one vector only make more parts.  Parts with tables of their own hold
   about ``LOCAL_PART`` rows and meet blocks of about as many queries.
7. A query that is left with fewer than ``k`` candidates is run again with a
   radius of all bits, which meets every row: the exact way for the rest.

Cases: vectors that are null, empty, zero, or hold a null or a component that
is not finite take no part, as query or candidate, nor do rows without an id
or, should lengths differ, vectors not of the most frequent length.  Rows that
share an id are rows of their own; a row is not a neighbour of rows with its
own id.  Ties go to the smaller id.  With fewer than ``k`` candidates all are
returned.  Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import table, written

K = 5
QUERY_EVERY = 50
SAMPLE = 4000
SAMPLE_QUERIES = 400
TARGET = 0.97
SUB_BITS = 8
PART = 2000
ITERATIONS = 30
SEED = 3
PAIRS_AT_ONCE = 100_000
LOCAL_PART = 8000
SCORES_AT_ONCE = 4_000_000
ROUNDING = 1e-9  # far above the error of a product of unit vectors in double precision


class Code(NamedTuple):
    mean: np.ndarray
    rotation: np.ndarray  # dimensions x bits
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow on the way."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def learn(vectors: np.ndarray, k: int = K, target: float = TARGET) -> Code:
    """Rotation and radius from a sample of at least one vector."""
    x = unit(vectors.astype("float64"))
    mean = x.mean(0)
    z = x - mean
    bits = -(-x.shape[1] // SUB_BITS) * SUB_BITS
    _, axes = np.linalg.eigh(z.T @ z)
    rnd = np.random.default_rng(SEED)
    spread = np.zeros((x.shape[1], bits))
    spread[:, :x.shape[1]] = axes[:, ::-1]
    if bits > x.shape[1]:  # more bits than dimensions: mix the axes into all of them
        spread = spread @ np.linalg.qr(rnd.normal(size=(bits, bits)))[0]
    y = z @ spread
    turn = np.linalg.qr(rnd.normal(size=(bits, bits)))[0]
    for _ in range(ITERATIONS):
        u, _, vt = np.linalg.svd(np.where(y @ turn >= 0, 1.0, -1.0).T @ y)
        turn = (u @ vt).T
    code = Code(mean, spread @ turn, bits)
    packed = codes_of(code, vectors)
    asked = np.linspace(0, len(x) - 1, min(SAMPLE_QUERIES, len(x))).astype(int)
    near = x[asked] @ x.T
    near[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-near, 1)[:, :min(k, len(x) - 1)]
    if not best.size:
        return code
    distances = np.sort(hamming(np.repeat(packed[asked], best.shape[1], 0), packed[best.ravel()]))
    return code._replace(radius=int(distances[min(len(distances) - 1, int(np.ceil(target * len(distances))) - 1)]))


def codes_of(code: Code, vectors: np.ndarray) -> np.ndarray:
    """n x bits/8 bytes."""
    return np.packbits((unit(vectors.astype("float64")) - code.mean) @ code.rotation >= 0, axis=1)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype="int32")


def probe_radii(code: Code, radius: int) -> list[int]:
    """How far each substring is probed so that no code within ``radius`` is missed (-1: not at all)."""
    n = code.bits // SUB_BITS
    return [min(SUB_BITS, radius // n - (i > radius % n)) for i in range(n)]


def flips(radius: int) -> np.ndarray:
    """The bytes with at most ``radius`` ones."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(SUB_BITS), r)], "uint8")


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the row of ``b``, summed alike wherever
    the rows stand.  Scaling by powers of two is exact and keeps squares in range."""
    a, b = (np.ldexp(v, -np.frexp(np.abs(v).max(1))[1][:, None]) for v in (a, b))
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


def best_in_bucket(queries: pd.DataFrame, index: pd.DataFrame, sub: int, radii: list[int], radius: int, k: int) -> pd.DataFrame:
    """The ``k`` nearest index rows of each query, among those within the
    radius that no substring before ``sub`` would have met."""
    parts: list[pd.DataFrame] = []
    if len(queries) and len(index):
        pack = lambda s: np.frombuffer(b"".join(s), "uint8").reshape(len(s), -1)
        qc, xc = pack(queries["q_code"]), pack(index["x_code"])
        qv, xv = np.stack(queries["q_vector"].to_numpy()).astype("float64"), np.stack(index["x_vector"].to_numpy()).astype("float64")
        q_id, x_id, q_row = queries["q_id"].to_numpy("int64"), index["x_id"].to_numpy("int64"), queries["q_row"].to_numpy("int64")
        step = max(1, PAIRS_AT_ONCE // len(xc))
        for first in range(0, len(qc), step):
            apart = np.bitwise_count(qc[first:first + step, None] ^ xc[None])
            near = apart.sum(2, dtype="int32") <= radius
            for earlier in range(sub):
                near &= apart[:, :, earlier] > radii[earlier]
            i, j = np.nonzero(near)
            i += first
            other = q_id[i] != x_id[j]
            i, j = i[other], j[other]
            score = np.concatenate([cosines(qv[i[a:a + PAIRS_AT_ONCE]], xv[j[a:a + PAIRS_AT_ONCE]]) for a in range(0, len(i), PAIRS_AT_ONCE)] or [np.empty(0)])
            order = np.lexsort((x_id[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            top = place < k
            i, j, score = i[top], j[top], score[top]
            parts.append(pd.DataFrame({"row": q_row[i], "query_id": q_id[i], "vec_id": x_id[j], "score": score}))
    return pd.concat(parts) if parts else pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("row", "int64"), ("query_id", "int64"), ("vec_id", "int64"), ("score", "float64"))})


def buckets_met(code: Code, radius: int) -> float:
    """How many substring tables meet a query with a row, on average over rows with even bytes."""
    return sum(len(flips(r)) for r in probe_radii(code, radius) if r >= 0) / 2 ** SUB_BITS


def within(queries: np.ndarray, index: np.ndarray, radii: list[int], radius: int) -> np.ndarray:
    """queries x index: which codes lie within ``radius``, found by probing the
    tables of ``index``.  Codes are rows of bytes."""
    padded = lambda c: np.ascontiguousarray(np.pad(c, ((0, 0), (0, -c.shape[1] % 8)))).view("uint64")
    qw, xw = padded(queries), padded(index)
    met = np.zeros((len(queries), len(index)), bool)
    every = np.arange(2 ** SUB_BITS, dtype="uint8")
    for sub, r in enumerate(radii):
        if r < 0:
            continue
        order = np.argsort(index[:, sub], kind="stable")
        ends = np.searchsorted(index[order, sub], np.arange(len(every) + 1))
        probes = np.bitwise_count(queries[:, sub][None] ^ every[:, None]) <= r
        for bucket in np.flatnonzero(np.diff(ends)):
            rows, asking = order[ends[bucket]:ends[bucket + 1]], np.flatnonzero(probes[bucket])
            if len(asking):
                apart = sum(np.bitwise_count(qw[asking, w][:, None] ^ xw[rows, w][None]).astype("uint16") for w in range(qw.shape[1]))
                met[np.ix_(asking, rows)] |= apart <= radius
    return met


def best_in_part(queries: pd.DataFrame, index: pd.DataFrame, radii: list[int], radius: int, k: int) -> pd.DataFrame:
    """The ``k`` nearest index rows of each query among those within the radius.
    One product of unit vectors finds the rows that can be among them, with all
    that come near the last; their cosines decide."""
    parts: list[pd.DataFrame] = []
    if len(queries) and len(index):
        pack = lambda s: np.frombuffer(b"".join(s), "uint8").reshape(len(s), -1)
        qc, xc = pack(queries["q_code"]), pack(index["x_code"])
        qv, xv = np.stack(queries["q_vector"].to_numpy()).astype("float64"), np.stack(index["x_vector"].to_numpy()).astype("float64")
        q_id, x_id, q_row = queries["q_id"].to_numpy("int64"), index["x_id"].to_numpy("int64"), queries["q_row"].to_numpy("int64")
        qu, xu = unit(qv), unit(xv)
        step = max(1, SCORES_AT_ONCE // len(xc))
        for first in range(0, len(qc), step):
            asked = slice(first, first + step)
            rough = qu[asked] @ xu.T
            rough[~within(qc[asked], xc, radii, radius) | (q_id[asked, None] == x_id[None])] = -np.inf
            last = np.partition(rough, -k, axis=1)[:, -k] if k < len(xc) else np.full(len(rough), -np.inf)
            i, j = np.nonzero((rough >= last[:, None] - ROUNDING) & (rough > -np.inf))
            i += first
            score = np.concatenate([cosines(qv[i[a:a + PAIRS_AT_ONCE]], xv[j[a:a + PAIRS_AT_ONCE]]) for a in range(0, len(i), PAIRS_AT_ONCE)] or [np.empty(0)])
            order = np.lexsort((x_id[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            top = np.arange(len(i)) - np.searchsorted(i, i) < k
            i, j, score = i[top], j[top], score[top]
            parts.append(pd.DataFrame({"row": q_row[i], "query_id": q_id[i], "vec_id": x_id[j], "score": score}))
    return pd.concat(parts) if parts else pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("row", "int64"), ("query_id", "int64"), ("vec_id", "int64"), ("score", "float64"))})


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    ok = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    kind = vectors.schema[vector].dataType.simpleString()
    return (vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(kind if kind == "array<float>" else "array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).filter(ok))


def search(rows: DataFrame, code: Code, asked: DataFrame, radius: int, k: int, part: int) -> DataFrame:
    """(row, query_id, vec_id, score): candidates of every row of ``asked``
    among ``rows``; both have row, id, vector and code."""
    radii = probe_radii(code, radius)
    subs = [i for i, r in enumerate(radii) if r >= 0]
    byte = [F.conv(F.hex(F.substring("code", i + 1, 1)), 16, 10).cast("int") for i in range(len(radii))]
    index = rows.select("*", F.inline(F.array(*(F.struct(F.lit(i).alias("sub"), byte[i].alias("bucket")) for i in subs))))
    probing = asked.select("*", F.inline(F.concat(*(_probes(byte[i], i, radii[i]) for i in subs))))

    def parts_of(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("sub", "bucket").agg(F.ceil(F.count("*") / part).cast("int").alias(name))

    # a bucket met from one side only is of no use; the table has a row for each (substring, byte) at most
    parts = F.broadcast(parts_of(index, "x_parts").join(parts_of(probing, "q_parts"), ["sub", "bucket"]))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = probing.join(parts, ["sub", "bucket"]).withColumn("q", deal("q_parts")).withColumn("x", every("x_parts"))
    right = index.join(parts, ["sub", "bucket"]).withColumn("x", deal("x_parts")).withColumn("q", every("q_parts"))
    keys = ["sub", "bucket", "q", "x"]
    own = lambda side: [F.col(c).alias(f"{side}_{c}") for c in ("row", "id", "code", "vector")]
    left, right = left.select(*keys, *own("q")), right.select(*keys, *own("x"))

    def bucket(key: tuple, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        return best_in_bucket(queries, candidates, int(key[0]), radii, radius, k)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(bucket, "row long, query_id long, vec_id long, score double")


def search_parts(rows: DataFrame, code: Code, asked: DataFrame, radius: int, k: int, part: int) -> DataFrame:
    """As ``search``, with the tables of a part of the rows built where the part is.  Counts both inputs."""
    radii = probe_radii(code, radius)
    x_parts, q_parts = (max(1, -(-df.count() // part)) for df in (rows, asked))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda side: [F.col(c).alias(f"{side}_{c}") for c in ("row", "id", "code", "vector")]
    left = asked.select(deal(q_parts).alias("q"), every(x_parts).alias("x"), *own("q"))
    right = rows.select(deal(x_parts).alias("x"), every(q_parts).alias("q"), *own("x"))

    def meeting(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        return best_in_part(queries, candidates, radii, radius, k)

    return left.groupBy("q", "x").cogroup(right.groupBy("q", "x")).applyInPandas(meeting, "row long, query_id long, vec_id long, score double")


def _probes(byte: Column, sub: int, radius: int) -> Column:
    """The buckets of a substring within ``radius`` bits of a query's."""
    return F.transform(F.array(*(F.lit(int(f)) for f in flips(radius))),
                       lambda f: F.struct(F.lit(sub).alias("sub"), byte.bitwiseXOR(f).alias("bucket")))


def nearest(spark: SparkSession, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = QUERY_EVERY,
            k: int = K, target: float = TARGET, sample: int = SAMPLE, part: int = PART, local_part: int = LOCAL_PART) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for every row whose id is divisible by ``every``."""
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = written(usable(vectors, vec_id, vector), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").head(1)
    if not lengths:
        return empty
    rows = rows.filter(F.size("vector") == lengths[0]["n"])
    some = rows.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(sample).select("vector").toArrow()["vector"].to_pylist()
    code = learn(np.array(some), k, target)
    shared = spark.sparkContext.broadcast(code)

    @F.pandas_udf("binary")
    def encode(vectors: pd.Series) -> pd.Series:
        return pd.Series([c.tobytes() for c in codes_of(shared.value, np.stack(vectors.to_numpy()))] if len(vectors) else [], dtype=object)

    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), "id", "vector", encode("vector").alias("code")), "codes")
    asked = rows.filter(F.col("id") % every == 0)

    def candidates(asking: DataFrame, radius: int) -> DataFrame:
        local = buckets_met(code, radius) >= 1
        return written(search_parts(rows, code, asking, radius, k, local_part) if local else search(rows, code, asking, radius, k, part), "candidates")

    found = candidates(asked, code.radius)
    few = asked.join(found.groupBy("row").count().filter(F.col("count") >= k).select("row"), "row", "left_anti")
    if code.radius < code.bits and few.head(1):
        wide = candidates(written(few, "few"), code.bits)
        found = found.join(wide.select("row").distinct(), "row", "left_anti").unionByName(wide)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"))
