"""Toxicity: a factorization machine over hashed terms.

A document is the set of its terms: its lower-cased words and the first
``STEMS`` letters of longer ones, so that an inflected word shares a term with
its other forms, all hashed into ``2**HASH_BITS`` buckets.  The model is

    z = b + sum_i w_i + sum_{i<j} <v_i, v_j>,   score = 1 / (1 + exp(-z))

over the terms present: beside each term's own weight it learns a weight for
every pair through the factors, so that two terms harmless alone can be toxic
together (and the other way round).

Fit: on at most ``SAMPLE_DOCS`` labelled ids, those with the smallest seeded
hash; executors turn their texts into term buckets and count them
by class, and only these counts and, of each row, the places of the buckets
that are kept come to the driver.  Two kinds of buckets get weights: the
``MAX_TERMS`` that tell the classes apart best by themselves (chi-square on
presence, at least ``MIN_SUPPORT`` documents), and up to ``MAX_PAIRED`` more
that do so only in pairs.  For these, the ``PAIR_TERMS`` buckets with the most
even presence are crossed: a pair counts if, over its four cells of presence,
the toxic shares depart from a sum of two effects (chi-square over
``PAIR_CHI``) and each cell expects ``LEAST_CELL`` documents of each class.
The crossing takes a bit a document and bucket to the driver, 2.5 MB at most.
Adagrad steps with L2 in numpy, seeded.  The fitted model is a table of fixed
size that goes to the tasks.

Scoring reads every whole text, in one narrow stage without a shuffle.

Cases: a null text has no terms, like an empty one or one without a word, and
gets the score of the bias alone; documents without an id are scored but never
learned from; a label other than 0 and 1, or null, is no label; an id
teaches once, by the text with the smallest hash and by most of its labels
(toxic on a tie), so a repeated id brings one row to the driver; without any labelled row of both classes the
score is the share of toxic rows learned from, 0 if there is none; equal rows
score alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm.common import bounded_batches, fold, table, written

HASH_BITS = 20
SAMPLE_DOCS = 20_000
MAX_TERMS = 4096
MIN_SUPPORT = 3
PAIR_TERMS = 1024
PAIR_CHI = 36.0
LEAST_CELL = 5
MAX_PAIRED = 512
FACTORS = 8
EPOCHS = 20
STEMS = (5, 7)
MEMO_WORDS = 200_000
SEED = 11
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
_WORD = re.compile(r"[^\W_]+")


class Model(NamedTuple):
    slots: np.ndarray  # bucket -> row of the weights, or -1
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _bucket(term: str) -> int:
    return zlib.crc32(term.encode()) & ((1 << HASH_BITS) - 1)


def terms_of(word: str) -> list[int]:
    """The buckets of a word and of its stems."""
    return [_bucket(word), *(_bucket(f"^{word[:n]}") for n in STEMS if len(word) > n)]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def buckets_of(text: str) -> set[int]:
    return {term for word in words_of(text) for term in terms_of(word)}


def _chi(both: np.ndarray, toxic: np.ndarray, n: int, p: float) -> np.ndarray:
    """Chi-square of each bucket's presence against the label; 0 without support or under one chance in a hundred."""
    p = max(p, 1e-9)
    chi = (toxic - both * p) ** 2 / np.maximum(both * p * (1 - p) * (1 - both / n) + 1e-9, 1e-9)
    return np.where((both < MIN_SUPPORT) | (chi < 6.6), 0, chi)


def _strong(both: np.ndarray, toxic: np.ndarray, n: int, p: float) -> np.ndarray:
    """The buckets that tell the classes apart by themselves, strongest first."""
    chi = _chi(both, toxic, n, p)
    order = np.lexsort((np.arange(len(chi)), -chi))[:MAX_TERMS]
    return order[chi[order] > 0]


def _counts(docs: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << HASH_BITS
    count = lambda which: np.bincount(np.concatenate([*which, np.empty(0, "int64")]).astype("int64"), minlength=size).astype(float)
    toxic = count([d for d, y in zip(docs, labels) if y])
    return toxic + count([d for d, y in zip(docs, labels) if not y]), toxic


def _candidates(both: np.ndarray, n: int, p: float) -> np.ndarray:
    """The buckets whose pairs are tested: most even presence first, enough of either class on both sides."""
    even = np.minimum(both, n - both)
    order = np.lexsort((np.arange(len(both)), -even))[:PAIR_TERMS]
    return order[even[order] * min(p, 1 - p) >= 2 * LEAST_CELL]


def _crossed(x: np.ndarray) -> np.ndarray:
    """How many rows hold each two columns of a matrix of booleans."""
    out = np.zeros((x.shape[1], x.shape[1]))
    for first in range(0, len(x), 2048):
        some = x[first:first + 2048].astype("float32")
        out += some.T @ some
    return out


def _paired(present: np.ndarray, labels: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Those of ``terms`` (the columns of ``present``) with a strong pair, strongest first."""
    if len(terms) < 2:
        return terms[:0]
    p = labels.mean()

    def cells(x: np.ndarray) -> np.ndarray:
        together, alone = _crossed(x), x.sum(0, dtype="float64")
        return np.stack([together, alone[:, None] - together, alone - together, len(x) - alone[:, None] - alone + together])

    n, toxic = cells(present), cells(present[labels > 0])
    share = toxic / np.maximum(n, 1)
    apart = share[0] - share[1] - share[2] + share[3]
    chi = apart**2 / (p * (1 - p) * (1 / np.maximum(n, 1)).sum(0))
    chi[n.min(0) * min(p, 1 - p) < LEAST_CELL] = 0
    best = chi.max(1)
    order = np.lexsort((terms, -best))
    return terms[order[best[order] > PAIR_CHI]]


def _kept(strong: np.ndarray, paired: np.ndarray) -> np.ndarray:
    return np.concatenate([strong, paired[~np.isin(paired, strong)][:MAX_PAIRED]])


def _presence(docs: list[np.ndarray], terms: np.ndarray) -> np.ndarray:
    at = np.sort(terms)
    out = np.zeros((len(docs), len(at)), bool)
    for i, d in enumerate(docs):
        out[i] = np.isin(at, d)
    return out


def _select(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The buckets that get weights: strong alone, then strong in pairs only."""
    both, toxic = _counts(docs, labels)
    n, p = len(docs), labels.mean()
    tested = np.sort(_candidates(both, n, p))
    return _kept(_strong(both, toxic, n, p), _paired(_presence(docs, tested), labels, tested))


def fit(docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, l2: float = 2e-5) -> Model:
    """A model of documents given as arrays of distinct buckets."""
    slots = np.full(1 << HASH_BITS, -1, "int32")
    labels = np.asarray(labels, float)
    base = labels.mean() if len(labels) else 0.0
    if not 0 < base < 1:
        return Model(slots, float("inf") if base else float("-inf"), np.zeros(0), np.zeros((0, FACTORS)))
    terms = _select(docs, labels)
    slots[terms] = np.arange(len(terms))
    rows = [s[s >= 0] for s in (slots[d.astype("int64")] for d in docs)]
    rnd = np.random.default_rng(SEED)
    bias, w, v = float(np.log(base / (1 - base))), np.zeros(len(terms)), rnd.normal(0, 0.05, (len(terms), FACTORS))
    sum_b, sum_w, sum_v = 1e-6, np.full(len(terms), 1e-6), np.full(v.shape, 1e-6)
    for _ in range(epochs):
        order = rnd.permutation(len(rows))
        for some in np.array_split(order, max(1, len(order) // 64)):
            lengths = np.array([len(rows[i]) for i in some])
            at, doc = np.concatenate([rows[i] for i in some]), np.repeat(np.arange(len(some)), lengths)
            both = np.zeros((len(some), FACTORS))
            np.add.at(both, doc, v[at])
            square = np.zeros((len(some), FACTORS))
            np.add.at(square, doc, v[at] ** 2)
            z = bias + np.bincount(doc, w[at], len(some)) + 0.5 * (both**2 - square).sum(1)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]) / len(some)
            used = np.unique(at)
            grad_w, grad_v = np.zeros(len(terms)), np.zeros(v.shape)
            np.add.at(grad_w, at, error[doc])
            np.add.at(grad_v, at, error[doc, None] * (both[doc] - v[at]))
            gw, gv, gb = grad_w[used] + l2 * w[used], grad_v[used] + l2 * v[used], error.sum()
            sum_w[used] += gw**2
            sum_v[used] += gv**2
            sum_b += gb**2
            w[used] -= rate * gw / np.sqrt(sum_w[used])
            v[used] -= rate * 0.3 * gv / np.sqrt(sum_v[used])
            bias -= 0.02 * gb / np.sqrt(sum_b)
    return Model(slots, bias, w, v)


def score_text(model: Model, text: str, memo: dict[str, tuple[int, ...]]) -> float:
    """The score of one text.  ``memo`` keeps the weighted terms of words seen
    before, up to ``MEMO_WORDS`` of them."""
    found: set[int] = set()
    for word in words_of(text):
        at = memo.get(word)
        if at is None:
            at = tuple(slot for slot in model.slots[terms_of(word)].tolist() if slot >= 0)
            if len(memo) < MEMO_WORDS:
                memo[word] = at
        if at:
            found.update(at)
    at = sorted(found)
    v = model.factors[at]
    z = model.bias + model.weights[at].sum() + 0.5 * (v.sum(0) ** 2 - (v**2).sum(0)).sum()
    return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Model:
    """Fit on labelled rows outside the held-out fold; ``docs`` has doc_id and
    text, ``labels`` has doc_id and toxic."""
    valid = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold("doc_id", FOLDS) != HELD_OUT))
    known = (valid.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("y"))
             .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample))
    body = F.coalesce("text", F.lit(""))
    one = docs.select("doc_id", body.alias("text")).join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def buckets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sorted(buckets_of(t)) for t in texts], dtype=object)

    rows = written(one.select("doc_id", "y", buckets("text").alias("terms")), "toxicity-sample")
    n, toxic_rows = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    found = (rows.select("y", F.explode("terms").alias("term")).groupBy("term")
             .agg(F.count("*").cast("int").alias("both"), F.sum("y").cast("int").alias("toxic")).filter(F.col("both") >= MIN_SUPPORT).toArrow().to_pandas())
    both, toxic = (np.zeros(1 << HASH_BITS) for _ in range(2))
    both[found.term], toxic[found.term] = found.both, found.toxic
    kept = np.empty(0, "int64")
    if 0 < toxic_rows < n:
        tested = np.sort(_candidates(both, n, toxic_rows / n))

        @F.pandas_udf("binary")
        def presence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for terms in batches:
                yield pd.Series([np.packbits(np.isin(tested, t)).tobytes() for t in terms], dtype=object)

        paired = tested[:0]
        if len(tested) > 1:
            bits = rows.select("y", presence("terms").alias("bits")).toArrow().to_pandas()
            packed = np.frombuffer(b"".join(bits["bits"]), "uint8").reshape(n, -1)
            paired = _paired(np.unpackbits(packed, axis=1, count=len(tested)).astype(bool), bits["y"].to_numpy(), tested)
        kept = np.sort(_kept(_strong(both, toxic, n, toxic_rows / n), paired))

    @F.pandas_udf(T.ArrayType(T.ShortType()))
    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for terms in batches:
            yield pd.Series([np.flatnonzero(np.isin(kept, t)).astype("int16") for t in terms], dtype=object)

    rows = rows.select("doc_id", "y", places("terms").alias("at")).toArrow().to_pandas()
    rows = rows.sort_values("doc_id")
    return fit([kept[np.asarray(at, "int64")].astype("int32") for at in rows["at"]], rows.y.to_numpy())


def scorer(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score of a text column.  The model has a fixed size (4 MB)."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, memo = shared.value, {}
        for texts in batches:
            yield pd.Series([score_text(model, t, memo) for t in texts], dtype="float64")

    return score(F.coalesce(text, F.lit("")))


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with its columns and toxic_score; learns from the labelled rows of ``docs``."""
    model = train(docs, labels)
    return docs.withColumn("toxic_score", scorer(spark, model, F.col("text")))


def without_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``."""
    return docs.filter(scorer(spark, train(docs, labels), F.col("text")) < threshold)


def op3_fm_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(spark, docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         F.col("toxic_score").alias("score"), (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"))
