import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import byte_bpe, token_count


def texts():
    rnd = random.Random(3)
    words = ["ciónes", "the", "Straße", "x1y2", "...", "déjà", "日本語", "🙂", "<s>", "it's", "  ", "\n", "\t\t", "1234"]
    out = [" ".join(rnd.choice(words) for _ in range(n)) for n in (1, 5, 400, 3000)]
    out += ["", " ", "a" * 5000, " " * 700 + "x", "x" + " " * 700, "x" + "\n" * 300 + "y", "ab " * 900, "é" * 900, "　  a \x1c b"]
    out += ["".join(rnd.choice(["a", " ", "\n", "1", "é", "▁", "."]) for _ in range(2000)) for _ in range(6)]
    return out


@pytest.mark.parametrize("chunk", [7, 64, 300])
def test_split_encoding_equals_whole(chunk):
    import re
    enc = byte_bpe.encoding(byte_bpe.RANK_FILE)
    run = re.compile(f"[{byte_bpe.WHITE_SPACE}]{{{chunk},}}")
    for t in texts():
        assert byte_bpe.encode_text(enc, t, chunk, run) == enc.encode_ordinary(t)


def test_very_long_run_of_spaces():
    enc = byte_bpe.encoding(byte_bpe.RANK_FILE)
    t = "ab" + " " * 1_200_000 + "cd"
    assert enc.decode_bytes(byte_bpe.encode_text(enc, t)) == t.encode()


@pytest.mark.parametrize("chunk,overlap", [(20, 3), (64, 8), (500, 40)])
def test_spliced_count_equals_whole(chunk, overlap):
    sp, proven = token_count.processor(token_count.MODEL_FILE)
    assert proven
    for t in texts():
        assert token_count.spliced_count(sp, t, chunk, overlap) == len(sp.encode(t))
        assert token_count.counts_of(token_count.MODEL_FILE, [t, "b", t], chunk, overlap) == [len(sp.encode(x)) for x in (t, "b", t)]


def frame(spark):
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts())] + [(100, None, None), (None, "null id", "z"), (5, "a" * 5000, "s5")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_round_trip_rows(spark):
    enc = byte_bpe.encoding(byte_bpe.RANK_FILE)
    docs = frame(spark)
    got = sorted(map(tuple, byte_bpe.round_trip(docs).collect()), key=repr)
    want = []
    for d, t, _ in docs.collect():
        ids = enc.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert byte_bpe.encode(docs).columns == ["doc_id", "text", "ids"]
    assert byte_bpe.round_trip(docs.filter("false")).count() == 0
    cut = byte_bpe.encode(docs.filter("doc_id = 2")).select(F.expr("substring(ids, 1, 4)").alias("ids"))
    assert byte_bpe.decode(cut).first()["decoded"] == enc.decode_bytes(enc.encode_ordinary(texts()[2])[:1])


def test_counts_rows(spark):
    sp, _ = token_count.processor(token_count.MODEL_FILE)
    docs = frame(spark)
    got = sorted(((r["doc_id"], r["n_tokens"]) for r in token_count.with_token_count(docs, chunk=50, overlap=4).collect()), key=repr)
    assert got == sorted(((d, len(sp.encode(t or ""))) for d, t, _ in docs.collect()), key=repr)
    assert token_count.with_token_count(docs.filter("false")).count() == 0


def test_queries_over_table(spark, sf):
    enc = byte_bpe.encoding(byte_bpe.RANK_FILE)
    sp, _ = token_count.processor(token_count.MODEL_FILE)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in byte_bpe.op8_byte_bpe(spark, sf).collect():
        ids = enc.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
    for r in token_count.op9_resync_token_counts(spark, sf).collect():
        t = docs[r["doc_id"]]
        n = len(sp.encode(t))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 4096)
