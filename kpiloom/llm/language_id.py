"""Language identification: a convolutional network over bytes.

Every byte of a window has a small embedding; filters of several widths run
over them, the largest response of each filter over the window is its feature,
and a softmax layer turns features into languages.  The network is trained in
numpy (Adam, seeded) on windows of a bounded sample of labelled rows:
about ``SAMPLE_DOCS`` ids (twice that at most), an equal share of each
language or all it has, those whose seeded hash is under the language's share
of its ids, and ``SAMPLE_WINDOWS`` places of each id's text (of several texts
of one id that with the smallest hash).

Applied, a text is cut into windows of ``WINDOW`` bytes, one after the other
until its end (the last one padded with byte 0); the windows of many texts are
evaluated together and a text's probabilities are the mean over its windows,
weighted by their bytes.  For that the embedding is multiplied into the
filters once, so that the response of a filter is a sum of table rows looked
up by byte pair.  One narrow stage without a shuffle; memory is bounded by the
block of windows, whatever the length of a text.

Cases: a text that is null or has no letter is ``und`` with score 0; without
any row to learn from every text is.  Documents without an id or language are
judged but not learned from; equal texts are judged alike; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import bounded_batches, fold, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
SAMPLE_DOCS = 4000
SAMPLE_WINDOWS = 3
EPOCHS = 4
LEAST_STEPS = 600
BATCH = 64
SEED = 5
BLOCK_WINDOWS = 1024
UNDETERMINED = "und"
FOLDS, HELD_OUT = 4, 2


class Net(NamedTuple):
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: width * EMBEDDING x FILTERS
    biases: list[np.ndarray]
    out: np.ndarray  # features x languages
    out_bias: np.ndarray


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Net:
    """A network trained on ``windows`` (n x WINDOW bytes) with label numbers."""
    rnd = np.random.default_rng(SEED)
    shapes = [(256, EMBEDDING), *((w * EMBEDDING, FILTERS) for w in WIDTHS), *((FILTERS,) for _ in WIDTHS), (FILTERS * len(WIDTHS), len(languages)), (len(languages),)]
    scale = [0.3, *(0.5 / np.sqrt(w) for w in WIDTHS), *(0.0 for _ in WIDTHS), 0.3, 0.0]
    params = [(rnd.normal(0, 1, shape) * s).astype("float32") for shape, s in zip(shapes, scale)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    k, step = len(WIDTHS), 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(windows)))):
        order = rnd.permutation(len(windows))
        for some in np.array_split(order, max(1, len(order) // BATCH)):
            emb, convs, biases, out, out_bias = params[0], params[1:1 + k], params[1 + k:1 + 2 * k], params[-2], params[-1]
            x = windows[some]
            e = emb[x]
            feats, winners = [], []
            for w, conv, bias in zip(WIDTHS, convs, biases):
                n = WINDOW - w + 1
                r = sum(e[:, j:j + n] @ conv[j * EMBEDDING:(j + 1) * EMBEDDING] for j in range(w))
                at = r.argmax(1)
                winners.append(at)
                feats.append(np.take_along_axis(r, at[:, None], 1)[:, 0] + bias)
            pre = np.concatenate(feats, 1)
            h = np.maximum(pre, 0)
            p = _softmax(h @ out + out_bias)
            p[np.arange(len(some)), labels[some]] -= 1
            p /= len(some)
            grads = [np.zeros_like(q) for q in params]
            grads[-2], grads[-1] = h.T @ p, p.sum(0)
            back = (p @ out.T) * (pre > 0)
            rows = np.arange(len(some))[:, None]
            for i, (w, conv, at) in enumerate(zip(WIDTHS, convs, winners)):
                g = back[:, i * FILTERS:(i + 1) * FILTERS].astype("float32")
                grads[1 + k + i] = g.sum(0)
                for j in range(w):
                    byte = x[rows, at + j]
                    grads[1 + i][j * EMBEDDING:(j + 1) * EMBEDDING] = np.einsum("bfe,bf->ef", emb[byte], g)
                    np.add.at(grads[0], byte.ravel(), (g[:, :, None] * conv[j * EMBEDDING:(j + 1) * EMBEDDING].T[None]).reshape(-1, EMBEDDING))
            step += 1
            rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for q, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= (rate * m / (np.sqrt(v) + 1e-7)).astype("float32")
    return Net(languages, params[0], params[1:1 + k], params[1 + k:1 + 2 * k], params[-2], params[-1])


class Reader:
    """A network with its filters as tables over byte pairs."""

    def __init__(self, net: Net):
        self.net = net
        bytes_ = [[net.embedding @ conv[j * EMBEDDING:(j + 1) * EMBEDDING] for j in range(w)] for w, conv in zip(WIDTHS, net.filters)]
        pairs = lambda one, two: (one[:, None] + two[None]).reshape(1 << 16, -1)
        # per width: (offset, table) of each byte pair, and of the last byte where the width is odd
        self.tables = [[(j, pairs(b[j], b[j + 1])) if j + 1 < len(b) else (j, b[j]) for j in range(0, len(b), 2)] for b in bytes_]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pair = (windows[:, :-1].astype("int32") << 8) | windows[:, 1:]
        feats = []
        for w, tables, bias in zip(WIDTHS, self.tables, self.net.biases):
            n, total = WINDOW - w + 1, None
            for j, rows in tables:
                part = rows.take((pair if len(rows) > 256 else windows)[:, j:j + n], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            feats.append(total.max(1) + bias)
        return _softmax(np.maximum(np.concatenate(feats, 1), 0) @ self.net.out + self.net.out_bias)

    def texts(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        """(language, score) of each text."""
        raw = [t.encode() for t in texts]
        counts = [max(1, -(-len(b) // WINDOW)) for b in raw]
        sums = np.zeros((len(raw), len(self.net.languages)))
        for first, last in self._groups(counts):
            buffer = b"".join(b.ljust(c * WINDOW, b"\0") for b, c in zip(raw[first:last], counts[first:last]))
            windows = np.frombuffer(buffer, "uint8").reshape(-1, WINDOW)
            owner = np.repeat(np.arange(first, last), counts[first:last])
            ends = np.cumsum(counts[first:last])
            weight = np.full(len(windows), float(WINDOW))
            weight[ends - 1] = [len(b) - (c - 1) * WINDOW or 1 for b, c in zip(raw[first:last], counts[first:last])]
            for at in range(0, len(windows), BLOCK_WINDOWS):
                p = self.probabilities(windows[at:at + BLOCK_WINDOWS]) * weight[at:at + BLOCK_WINDOWS, None]
                np.add.at(sums, owner[at:at + BLOCK_WINDOWS], p)
        best = sums.argmax(1)
        share = sums[np.arange(len(raw)), best] / np.maximum(sums.sum(1), 1e-300)
        yield from ((self.net.languages[b], float(min(1.0, s))) for b, s in zip(best, share))

    @staticmethod
    def _groups(counts: list[int]) -> Iterator[tuple[int, int]]:
        """Ranges of texts of about BLOCK_WINDOWS windows together."""
        first = size = 0
        for i, c in enumerate(counts):
            size += c
            if size >= BLOCK_WINDOWS:
                yield first, i + 1
                first, size = i + 1, 0
        if first < len(counts):
            yield first, len(counts)


def sample_windows(docs: DataFrame, sample: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows, label numbers and languages of the bounded sample."""
    rows = docs.filter(F.col("lang").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
    known = rows.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    parts = [F.lit(x) for lang in languages for x in (lang, min(1.0, sample / len(languages) / counts[lang]))]
    place = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(place < F.create_map(*parts)[F.col("lang")] if parts else F.lit(False))
    ids = chosen.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(2 * sample)
    body = F.coalesce("text", F.lit("")).cast("binary")
    places = F.transform(F.sequence(F.lit(1), F.lit(SAMPLE_WINDOWS)), lambda i: F.substring(
        body, F.pmod(F.xxhash64("doc_id", i), F.greatest(F.octet_length(body) - WINDOW + 1, F.lit(1))).cast("int") + 1, F.lit(WINDOW)))
    one = (docs.select("doc_id", "text").filter(F.col("text").rlike(r"\p{L}")).join(F.broadcast(ids), "doc_id")
           .groupBy("doc_id", "lang").agg(F.min_by(F.array_distinct(places), F.xxhash64("text")).alias("windows")))
    found = one.select("doc_id", "lang", F.explode("windows").alias("window")).collect()
    found.sort(key=lambda r: (r["doc_id"], r["lang"], r["window"]))
    windows = np.frombuffer(b"".join(bytes(r["window"]).ljust(WINDOW, b"\0") for r in found), "uint8").reshape(-1, WINDOW)
    return windows, np.array([languages.index(r["lang"]) for r in found], "int64"), languages


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Net | None:
    windows, labels, languages = sample_windows(docs.select("doc_id", "text", "lang"), sample)
    if not len(windows):
        return None
    return fit(windows, labels, languages)


def predictor(spark: SparkSession, net: Net | None, text: Column) -> Column:
    """struct(lang, score) of a text column.  The network is a few kB."""
    readable = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    nothing = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    if net is None:
        return nothing
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(net)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for texts in batches:
            yield pd.DataFrame(reader.texts(list(texts)), columns=["lang", "score"])

    return F.when(readable, predict(F.coalesce(text, F.lit("")))).otherwise(nothing)


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with its columns and language_id, a struct of lang and score;
    learns from the rows of ``docs`` that have a language."""
    return docs.withColumn("language_id", predictor(spark, train(docs), F.col("text")))


def with_known_language(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in some learned language, whatever the score: a
    text that mixes languages, or a short one, has a low score but is no junk."""
    found = predictor(spark, train(docs), F.col("text"))
    return docs.filter(found["lang"] != UNDETERMINED)


def op6_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(spark, docs).select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                                        F.col("language_id.lang").alias("lang_pred"), F.col("language_id.score").alias("score"))
