"""Periodic runs against a quadratic search for every period."""

import hashlib
import random

import pytest

from kpiloom.llm import runs as R


def brute(w, least):
    found, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.append((i, j - i + q, q))
            i = j
    smallest = lambda s, n, q: all(any(w[k] != w[k + p] for k in range(s, s + n - p)) for p in range(1, q))
    return sorted((r for r in found if smallest(*r)), key=lambda r: (r[0], r[2]))


def _texts(rng):
    w = [b"%d" % rng.randrange(rng.randint(1, 4)) for _ in range(rng.randrange(60))]
    if w and rng.random() < 0.5:
        p, a = rng.randint(1, len(w)), rng.randrange(len(w))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


@pytest.mark.parametrize("block", [2, 512])
def test_brute_force(monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        least, docs = rng.choice([2, 3, 7, 12]), [_texts(rng) for _ in range(rng.randint(1, 4))]
        assert R.runs_of_batch(docs, least) == [brute(w, least) for w in docs]


def test_very_long_texts():
    assert R.runs_of_batch([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert R.runs_of_batch([[b"x"] + [b"%d" % (i % 999) for i in range(150_000)]]) == [[(1, 150_000, 999)]]


def test_planted_words():
    import zlib

    for i in range(500):
        h, at = zlib.crc32(b"%d" % i), R.planted(i, 50)
        assert (at is None) == (h % 10 != 0)
        if at:
            a = h // 10 % 50
            assert at == (a, 1 + (50 - a) // (3 + h // 10 % 8))
    assert R.planted(None, 5) is None and R.planted(0, 0) is None


def _want(doc_id, text, plant):
    w = (text or "").encode().split()
    if plant and (at := R.planted(doc_id, len(w))):
        a, p = at
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute(w, R.MIN_LENGTH)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, runs,
            b" ".join(x for i, x in enumerate(w) if i not in gone).decode())


def test_cases(spark):
    """Null, empty and repeated rows, null ids, white space of every kind, clashing columns, an empty table."""
    texts = [None, "", " \t\n\x0b\x0c\r ", "a\x1cb " * 9, "x " * 11, "x " * 12, "a b c " * 20, "é ß " * 30, "q " * 40] * 2
    rows = [(None if i % 5 == 0 else i, t, "r", 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int")
    for plant in (False, True):
        got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, [tuple(x[k] for k in ("start", "length", "period")) for x in r.runs], r.collapsed)
               for r in R.with_runs(df, plant=plant).collect()]
        assert sorted(got, key=str) == sorted((_want(i, t, plant) for i, t, *_ in rows), key=str)
    assert R.with_runs(df.limit(0)).count() == 0


def test_query_over_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in R.op13_suffix_class_runs(spark, sf).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    small = [d for d in docs if len((d.text or "").split()) <= 1500]
    assert len(got) == len(docs) and len(small) > 0.8 * len(docs)
    for d in small:   # the brute force is quadratic; longer texts are held against it in test_very_long_texts
        i, n, start, length, period, milli, runs, collapsed = _want(d.doc_id, d.text, True)
        assert got[d.doc_id] == (i, n, start, length, period, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(collapsed))
