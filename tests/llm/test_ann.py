import math
from collections import Counter

import numpy as np
import pytest

from kpiloom.llm import ann


def brute(rows, every=50, k=5):
    """(query row number, query id) -> [(score, id)] by comparing all."""
    out = []
    for n, (q, v) in enumerate(rows):
        if q % every == 0:
            v = np.array(v, float)
            near = sorted(((-float((v * w).sum() / np.sqrt((v * v).sum() * (w * w).sum())), d) for d, w in ((d, np.array(w, float)) for d, w in rows) if d != q))
            out.append((q, [(d, -s) for s, d in near[:k]]))
    return out


def recall(got, want, k=5):
    by = {}
    for r in got:
        by.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(by.get(q, set()) & {d for d, _ in near}) for q, near in want)
    return hits / sum(len(near) for _, near in want)


def check_shape(got, want):
    sizes = Counter(r["query_id"] for r in got)
    assert sizes == Counter({q: len(near) for q, near in want if near})
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append(r)
    for own in by.values():
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        order = [(-r["score"], r["vec_id"]) for r in own]
        assert order == sorted(order)


@pytest.mark.parametrize("radius", [0, 3, 9, 17, 30, 64])
def test_pigeonhole_meets_every_code_within_the_radius_once(radius):
    rnd = np.random.default_rng(radius)
    code = ann.Code(np.zeros(64), np.eye(64), radius)
    radii = ann.probe_radii(code, radius)
    for _ in range(200):
        a = rnd.integers(0, 256, 8, "uint8")
        b = a.copy()
        for bit in rnd.choice(64, rnd.integers(0, radius + 1), replace=False):
            b[bit // 8] ^= 1 << (bit % 8)
        apart = np.bitwise_count(a ^ b)
        assert any(r >= 0 and d <= r for d, r in zip(apart, radii))
        i = next(i for i, (d, r) in enumerate(zip(apart, radii)) if r >= 0 and d <= r)
        assert (a[i] ^ b[i]) in ann.flips(radii[i])


def test_search_within_radius_is_exact(spark):
    rnd = np.random.default_rng(1)
    rows = [(int(i), rnd.normal(size=16).tolist()) for i in rnd.permutation(400)]
    code = ann.learn(np.array([v for _, v in rows]))._replace(radius=5)
    assert code.bits == 16
    codes = ann.codes_of(code, np.array([v for _, v in rows]))
    df = spark.createDataFrame([(n, d, v, bytearray(c.tobytes())) for n, ((d, v), c) in enumerate(zip(rows, codes))], "row long, id long, vector array<double>, code binary")
    asked = df.filter("id % 7 = 0")
    for way, part in ((ann.search, 2000), (ann.search, 3), (ann.search_parts, 2000), (ann.search_parts, 30)):
        got = way(df, code, asked, 5, 10_000, part).collect()
        want = {(i, rows[j][0]) for i in range(400) for j in range(400) if rows[i][0] % 7 == 0 and i != j and np.bitwise_count(codes[i] ^ codes[j]).sum() <= 5}
        assert len(got) == len(want) and {(r["row"], r["vec_id"]) for r in got} == want


@pytest.mark.parametrize("bits,radius", [(8, 3), (16, 5), (64, 29), (72, 20)])
def test_tables_of_a_part_find_every_code_within_the_radius(bits, radius):
    rnd = np.random.default_rng(bits)
    code = ann.Code(np.zeros(bits), np.eye(bits), radius)
    a, b = rnd.integers(0, 256, (30, bits // 8), "uint8"), rnd.integers(0, 256, (500, bits // 8), "uint8")
    assert (ann.within(a, b, ann.probe_radii(code, radius), radius) == (np.bitwise_count(a[:, None] ^ b[None]).sum(2) <= radius)).all()


def test_both_places_of_the_tables_return_the_same_nearest(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(300, 32))
    rows = [(int(i), base[i % 300].tolist()) for i in range(900)] + [(9, base[5].tolist())]
    codes_ = ann.learn(np.array([v for _, v in rows]))
    packed = ann.codes_of(codes_, np.array([v for _, v in rows]))
    df = spark.createDataFrame([(n, d, v, bytearray(c.tobytes())) for n, ((d, v), c) in enumerate(zip(rows, packed))], "row long, id long, vector array<double>, code binary")
    asked = df.filter("id % 9 = 0")

    def best(found):
        by = {}
        for r in found.collect():
            by.setdefault(r["row"], []).append((-r["score"], r["vec_id"]))
        return {row: sorted(own)[:5] for row, own in by.items()}

    for radius in (6, 20, 32):
        assert best(ann.search(df, codes_, asked, radius, 5, 40)) == best(ann.search_parts(df, codes_, asked, radius, 5, 70))


def test_scores_are_exact():
    a = np.array([[3.0, 4.0], [1e200, 1e200], [1e-200, 0.0], [1.0, 1.0]])
    b = np.array([[4.0, 3.0], [1e-180, 1e-180], [1e300, 0.0], [-1.0, -1.0]])
    assert ann.cosines(a, b) == pytest.approx([0.96, 1, 1, -1], abs=1e-15)


def test_bad_vectors_ties_and_copies(spark):
    rnd = np.random.default_rng(2)
    good = [(int(i), rnd.normal(size=12).tolist()) for i in range(120)]
    good += [(1000 + i, good[50][1]) for i in range(60)] + [(50, good[7][1])]
    bad = [(None, good[0][1]), (200, None), (250, []), (300, [0.0] * 12), (350, [None] + good[0][1][1:]), (400, [math.nan] + good[0][1][1:]), (450, [math.inf] + good[0][1][1:]), (500, [1.0])]
    df = spark.createDataFrame([(d, v, 1.0, 2) for d, v in good + bad], "vec_id long, embedding array<double>, score double, row int")
    got = ann.nearest(spark, df, sample=100, part=7, local_part=9).collect()
    want = brute(good)
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == {0, 50, 100, 1000, 1050}
    assert [r["vec_id"] for r in sorted(by[1000], key=lambda r: r["rank"])] == [50, 1001, 1002, 1003, 1004]
    assert recall([r for r in got if r["query_id"] != 50], [w for w in want if w[0] != 50]) > 0.85
    assert ann.nearest(spark, df.filter("false")).count() == 0
    assert ann.nearest(spark, df.filter("vec_id in (200, 300)")).count() == 0
    two = ann.nearest(spark, df.filter("vec_id in (0, 1, 2)")).collect()
    check_shape(two, brute(good[:3]))
    assert ann.nearest(spark, df.filter("vec_id = 0")).count() == 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.1"])
def test_query_over_table(spark, scale):
    path = f"/root/testdata/{scale}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = ann.op10_multi_index_hashing(spark, path).collect()
    want = brute(rows)
    check_shape(got, want)
    assert recall(got, want) >= 0.9
    exact = {(q, d): s for q, near in want for d, s in near}
    assert all(abs(r["score"] - exact.get((r["query_id"], r["vec_id"]), r["score"])) < 1e-14 for r in got)
