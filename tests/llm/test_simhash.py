import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from kpiloom.llm import simhash


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """doc_id -> smallest reachable, from every pair of rows."""
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = [(d, f) for d, f in rows if d is not None]
    for d, _ in fps:
        parent.setdefault(d, d)
    for i, (d, f) in enumerate(fps):
        for e, g in fps[:i]:
            if (f ^ g).bit_count() <= 4 and root(d) != root(e):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: root(d) for d in parent}


def signed(f):
    return f - (1 << 64) if f >> 63 else f


TEXTS = [None, "", " \t\n", "one", "Two words", "a b c", "A B c D", "É é İ a\x0bb\x0cc\rd e", "x " * 9, "one two three four five", "w " * 120_000 + "end"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint_of(text or "") == brute_fingerprint(text)


def test_fingerprint_uses_sparks_hash(spark):
    from pyspark.sql import functions as F
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] == signed(xxhash.xxh64(b"a b c d", seed=42).intdigest())
    assert spark.createDataFrame([(signed(10),), (-1,)], "fp long").select(simhash.hex_of(F.col("fp"))).collect()[0][0] == "000000000000000a"


def near(rnd, n, groups=4):
    centres = [rnd.getrandbits(64) for _ in range(groups)]
    out = []
    for _ in range(n):
        f = rnd.choice(centres) if rnd.random() < 0.6 else rnd.getrandbits(64)
        for _ in range(rnd.randint(0, 6)):
            f ^= 1 << rnd.randrange(64)
        out.append(f)
    return out + [0, (1 << 64) - 1, 1 << 63]


@pytest.mark.parametrize("radius", [0, 2, 4, 7])
def test_bit_sliced_links(radius):
    rnd = random.Random(radius)
    left, right = near(rnd, 150), near(rnd, 130)
    right += left[:40]
    got = {(int(a), int(b)) for i, j in simhash.links_of(np.array(left, "uint64"), np.array(right, "uint64"), radius, 64) for a, b in zip(i, j)}
    assert got == {(i, j) for i, f in enumerate(left) for j, g in enumerate(right) if (f ^ g).bit_count() <= radius}


@pytest.mark.parametrize("rows", [10, 3000, 1 << 22, 1 << 30])
def test_every_pair_meets(rows):
    masks = simhash.tables_for(rows)
    rnd = random.Random(1)
    for _ in range(300):
        f = g = rnd.getrandbits(64)
        for b in rnd.sample(range(64), 4):
            g ^= 1 << b
        assert any(f & m == g & m for m in masks)


@pytest.mark.parametrize("bucket,split", [(256, 1024), (8, 16)])
def test_components_against_all_pairs(spark, bucket, split):
    rnd = random.Random(9)
    fps = near(rnd, 400)
    chain = [rnd.getrandbits(64)]
    for _ in range(30):  # neighbours link, ends are far apart
        f = chain[-1]
        for b in rnd.sample(range(64), 4):
            f ^= 1 << b
        chain.append(f)
    rows = list(zip(rnd.sample(range(10_000), len(fps) + 31), fps + chain))
    nodes = defaultdict(list)
    for d, f in rows:
        nodes[f].append(d)
    df = spark.createDataFrame([(min(d), signed(f)) for f, d in nodes.items()], "id long, fp long").repartition(4)
    got = {r["id"]: r["component"] for r in simhash.components(simhash.links(df, df.count(), bucket=bucket, split=split)).collect()}
    want = brute_components([(min(d), f) for f, d in nodes.items()])
    assert {d: got.get(d, d) for d in want} == want


def test_rows(spark):
    base = " ".join(f"word{i}" for i in range(120))
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, base + f" tail{i}") for i in range(6)] + [(50, base), (50, base), (51, base), (None, base), (None, "only null has this text here"),
            (60, "first text of sixty is this one"), (60, "and the second text is that other one"), (61, "and the second text is that other one")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, fp int, component_id string")
    got = [tuple(r) for r in simhash.near_duplicates(df, bucket=4, split=8).collect()]
    prints = [(d, brute_fingerprint(t)) for d, t in docs]
    want = brute_components(prints)
    null_component = {f: min(want[e] for e, g in prints if e is not None and g == f) for d, f in prints if d is None and any(e is not None and g == f for e, g in prints)}
    assert Counter(got) == Counter((d, signed(f), want[d] if d is not None else null_component.get(f)) for d, f in prints)
    assert simhash.near_duplicates(df.filter("false")).count() == 0


def test_rows_without_an_id(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(simhash, "fingerprints", lambda df, text="text", out="fp", shingle=4: df.withColumn(out, F.col(text).cast("long")))
    far = 0x5555 << 40
    docs = [(3, "0"), (None, "15"), (5, "255"), (None, "15"),  # 0 and 255 meet through 15, which has no id
            (None, str(far)), (None, str(far)), (None, str(far + 1)), (9, str(0x7777 << 20)), (None, str(0x7777 << 20))]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, extra int")
    got = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert got[(3, 0)] == got[(5, 255)] == got[(None, 15)] == 3 and got[(None, far)] is None and got[(None, 0x7777 << 20)] == 9
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [("3", "0"), ("9", str(0x7777 << 20)), ("None", str(far))]


def test_query_over_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    prints = [(d, brute_fingerprint(t)) for d, t in docs]
    want = brute_components(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op7_bitsliced_simhash(spark, sf).collect()}
    assert got == {d: (f"{f:016x}", want[d]) for d, f in prints}
