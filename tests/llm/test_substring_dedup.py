"""Substring dedup against brute force: every window of every text counted by its words."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from kpiloom.llm import substring_dedup as S


def brute(texts, window=S.WINDOW):
    words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def _check(spark, texts, window, **limits):
    df = spark.createDataFrame([(i, t, "x", 1, True) for i, t in enumerate(texts)], "doc_id long, text string, kept string, text_id int, whole boolean").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in S.without_repeats(df, window=window, **limits).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def _corpus(seed, n=120):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    texts = [None, "", " \t\n", "one two", "a " * 60, "a b c " * 30, "é\x1cß　x " * 20]
    for _ in range(n):
        w = [f"w{rng.randrange(rng.choice([2, 5, 400]))}" for _ in range(rng.randrange(50))]
        if rng.random() < 0.5:
            at, cut = rng.randrange(len(w) + 1), rng.randrange(len(passage))
            w[at:at] = passage[cut:] if rng.random() < 0.5 else passage
        texts.append(rng.choice(["  ", " ", "\n"]).join(w))
    return texts + texts[::7] + texts[8:9] * 12


@pytest.mark.parametrize("m", [1, 4, 9])
def test_brute_force(spark, m):
    _check(spark, _corpus(m), 9, m=m)


def test_hot_minimisers_and_frequent_texts(spark):
    _check(spark, _corpus(7), 9, m=4, least_hot=0, hot_minimisers=1 << 40)   # every bucket is split by windows
    _check(spark, _corpus(8), 9, m=4, least_hot=4, least_heavy=3)            # some are, and copied texts need no join
    _check(spark, _corpus(9), 9, m=4, max_blocks=1)                          # a full filter lets all pass


def test_super_k_mers_hold_every_window_once():
    rng = random.Random(5)
    docs = [[b"%d" % rng.randrange(3) for _ in range(rng.randrange(40))] for _ in range(50)]
    doc, start, windows, minimiser = S.super_k_mers(docs, 9, 4)
    held = Counter((d, s + k) for d, s, n in zip(doc.tolist(), start.tolist(), windows.tolist()) for k in range(n))
    assert held == Counter((d, i) for d, w in enumerate(docs) for i in range(len(w) - 8))
    assert windows.max() <= 9 - 4 + 1
    of = {}
    for d, s, n, v in zip(doc.tolist(), start.tolist(), windows.tolist(), minimiser.tolist()):
        for k in range(n):
            assert of.setdefault(tuple(docs[d][s + k:s + k + 9]), v) == v   # equal windows, equal bucket


def test_filter_passes_all_its_keys(spark):
    keys = np.array([random.Random(1).getrandbits(64) - 2**63 for _ in range(3000)] + [0, -1, 2**63 - 1, -2**63])
    words = S.minimiser_filter(spark.createDataFrame([(int(k),) for k in keys], "minimiser long"))
    assert S.possible(words, keys).all()
    other = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 20000)
    assert S.possible(words, other).mean() < 0.02


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.without_repeats(empty).columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert S.without_repeats(empty).count() == 0
    long = " ".join(f"w{i}" for i in range(40))
    rows = S.without_repeats(spark.createDataFrame([(None, long), (None, long), (3, long + " x")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.n_words, r.n_removed, r.kept) for r in rows) == [(False, 41, 40, "x"), (True, 40, 40, ""), (True, 40, 40, "")]


def test_query_over_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {d.doc_id: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, (n, gone, kept) in zip(docs, brute([d.text for d in docs]))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.op11_super_k_mer_dedup(spark, sf).collect()}
    assert got == want
