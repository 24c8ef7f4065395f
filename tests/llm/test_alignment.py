"""Cross-tokenizer alignment against the two libraries and a quadratic count of overlaps."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest

from kpiloom.llm import alignment as A
from kpiloom.llm.skew import looked_up

PARTS = ["a", "b", "the", " ", "  ", "é", "ß", "\n", "漢字", "😀", "<s>", "</s>", "<0x41>", "<|endoftext|>", "ing", "\t", "1", "2024", ".",
         "'s", "　", " to", "  x", " of", "unk"]


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(A.A_FILE))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(A.B_FILE))
    return lambda x: t.encode(x, add_special_tokens=False).ids, sp.encode


def brute(text, libraries):
    """(a ids, b ids, groups, links), or None."""
    if not text:
        return None
    a, b = libraries[0](" " + text), libraries[1](text)
    a_bytes, b_bytes = A.tokenizer_a(A.A_FILE)[1], A.tokens_b(A.B_FILE)
    raw = (" " + text).encode()
    if b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
        return None
    a_ends, b_ends = [list(accumulate(len(of[i]) for i in ids)) for of, ids in ((a_bytes, a), (b_bytes, b))]
    groups, i, j = [], 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        i2, j2 = a_ends.index(cut) + 1, b_ends.index(cut) + 1
        groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
        i, j = i2, j2
    links, j = Counter(), 0
    for k, (begin, end) in enumerate(zip([0, *a_ends], a_ends)):
        while b_ends[j] <= begin:
            j += 1
        at = j
        while at < len(b) and (b_ends[at - 1] if at else 0) < end:
            links[a[k] * A.B_IDS + b[at]] += 1
            at += 1
    return a, b, ";".join(groups), links


def test_pieces_of_any_size_stitch_to_the_whole(libraries):
    rng = random.Random(3)
    seen = 0
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(40)))
        chunk, want = rng.choice([1, 3, 10, 1000]), brute(text, libraries)
        got = A.encode_both(text, chunk=chunk)
        assert (got is None) == (want is None)
        if want is None:
            continue
        seen += 1
        a, b = got
        assert (a.tolist(), b.tolist()) == want[:2]
        a_ends, b_ends = A._widths(A.A_FILE, "a")[a].cumsum(), A._widths(A.B_FILE, "b")[b].cumsum()
        for steps in (1, 2, 7, 1000):
            pieces, links = [], Counter()
            for s in A.slices(a, b, a_ends, b_ends, steps):
                assert s["own_a"] + s["own_b"] <= steps + 1   # equal work, but for an end that both have
                x, y = np.frombuffer(s["a"], np.int32), np.frombuffer(s["b"], np.int32)
                pieces.append(A.merged(x, y, s["a_from"] + A._widths(A.A_FILE, "a")[x].cumsum(), s["b_from"] + A._widths(A.B_FILE, "b")[y].cumsum(), s["own_a"], s["own_b"]))
                links.update(dict(zip(pieces[-1]["pairs"].tolist(), pieces[-1]["counts"].tolist())))
            assert A.stitched(pieces) == want[2] and links == want[3]
            assert sum(p["n_links"] for p in pieces) == sum(want[3].values())
    assert seen > 200


def _want(rows, libraries):
    done = [brute(t, libraries) for t in rows]
    total = sum((d[3] for d in done if d), Counter())
    most = Counter()
    for pair, n in total.items():
        most[pair % A.B_IDS] = max(most[pair % A.B_IDS], n)
    zero = (0, 0, 0, 0, 0, 0, "")
    return [zero if d is None else (len(d[0]), len(d[1]), d[2].count(";") + 1, sum(d[3].values()),
                                    sum(n for p, n in d[3].items() if total[p] == most[p % A.B_IDS]), sum(n * total[p] for p, n in d[3].items()),
                                    hashlib.sha256(d[2].encode()).hexdigest()) for d in done]


def _rows(spark, documents, links, heavy):
    from pyspark.sql import functions as F

    totals = A.written(A.pair_totals(links), "test-totals")
    sums = looked_up(links, totals, "pair", "total", heavy).groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum"))
    return documents.join(sums, "_row", "left").na.fill(0, ["n_best", "count_sum"]).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "digest").collect()


@pytest.mark.parametrize("steps,heavy", [(5, 1), (A.PIECE_STEPS, 1 << 16)])
def test_documents(spark, libraries, steps, heavy):
    """Nulls, empty texts, repeated rows, equal ids, clashing columns, texts of many pieces."""
    rng = random.Random(steps)
    texts = [None, "", " ", "▁", "x" * 300, "so it goes " * 40] + ["".join(rng.choice(PARTS) for _ in range(30)) for _ in range(40)]
    texts += texts[:20]
    df = spark.createDataFrame([(None if i == 3 else i // 2, t, i, "p") for i, t in enumerate(texts)], "doc_id long, text string, _row int, slices string").repartition(3)
    documents, links = A.aligned(df, chunk=10, steps=steps)
    got = sorted((r.doc_id or -1, *r[1:]) for r in _rows(spark, documents, links, heavy))
    assert got == sorted((-1 if i == 3 else i // 2 or -1, *w) for i, w in enumerate(_want(texts, libraries)))


def test_empty_table(spark):
    documents, links = A.aligned(spark.createDataFrame([], "doc_id long, text string"))
    assert _rows(spark, documents, links, 4) == [] and links.count() == 0


def test_query_over_table(spark, sf, libraries):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in A.op12_merge_path_alignment(spark, sf).collect()}
    assert got == {d.doc_id: w for d, w in zip(docs, _want([d.text for d in docs], libraries))}
