import zlib
from collections import Counter, defaultdict

from kpiloom.llm import sharding


def check(rows, docs, shards):
    n = len(docs)
    assert len(rows) == n
    size = lambda t: 16 + (len(t.encode()) if t is not None else 0)
    crc = lambda t: zlib.crc32(t.encode()) if t is not None else None
    assert Counter((r["doc_id"], r["source"], r["size"], r["text_crc32"]) for r in rows) == Counter((d, s, size(t), crc(t)) for d, t, s in docs)
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards
        by[r["shard"]].append(r)
    counts = [len(by[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sources = Counter(s for _, _, s in docs)
    for s, m in sources.items():
        for shard in range(shards):
            assert abs(sum(r["source"] == s for r in by[shard]) - m / shards) <= 2, (s, shard)


def brute(docs_with_hash, shards, seed_phase):
    """The same order from one sort in memory: (fraction, stratum, hash, ...)."""
    by = defaultdict(list)
    for row in docs_with_hash:
        by[row[0]].append(row[1:])
    order = []
    for stratum, rows in by.items():
        for i, r in enumerate(sorted(rows, key=lambda r: r[0])):
            order.append(((i + seed_phase[stratum]) / len(rows), stratum, r))
    order.sort(key=lambda x: (x[0], x[1], x[2][0]))
    n = len(order)
    return {r[1]: (p * shards // n, p - -(-(p * shards // n) * n // shards)) for p, (_, _, r) in enumerate(order)}


def test_shards_of_table(spark, sf):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.op1_stratified_interleave(spark, sf).collect()
    assert rows[0].asDict().keys() == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source"}
    check(rows, [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], 40)
    body = F.col("text").cast("binary")
    hashed = docs.select(F.concat(F.lit("="), "source").alias("s"),
                         F.xxhash64(F.lit(sharding.SEED), "doc_id", F.crc32(body), F.octet_length(body).cast("long") + 16).alias("h"), "doc_id").collect()
    mask = (1 << 64) - 1
    phases = {r["s"]: (((r["p"] & mask) >> 44) + 0.5) / (1 << 20) for r in docs.select(F.concat(F.lit("="), "source").alias("s")).distinct()
              .select("s", F.xxhash64(F.lit(sharding.SEED), "s").alias("p")).collect()}
    want = brute([(r["s"], r["h"] & mask, r["doc_id"]) for r in hashed], 40, phases)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in rows} == want


def test_nulls_ties_and_hot_source(spark):
    docs = [(i, f"text {i}", "hot") for i in range(300)] + [(i, None, None) for i in range(300, 360)] + [(7, "same", "x")] * 90
    docs += [(None, "é", "y")] * 25 + [(None, None, None)] * 5 + [(i, "", "z") for i in range(500, 503)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "'x' as stratum", "1 as h", "2 as shard")
    check(sharding.interleave(df, shards=7).collect(), docs, 7)
    again = sharding.interleave(df.repartition(5), shards=7)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, sharding.interleave(df, shards=7).collect()))


def test_equal_rows_unfold_in_blocks(spark):
    docs = [(7, "same", "x")] * 1000 + [(i, f"t{i}", "x") for i in range(50)] + [(None, None, None)] * 300
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = sharding.interleave(df, shards=7, block=64)
    check(rows.collect(), docs, 7)
    assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, sharding.interleave(df, shards=7).collect()))


def test_few_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "s"), (2, "b", "s")], "doc_id long, text string, source string")
    rows = sharding.interleave(df, shards=5).collect()
    assert len(rows) == 2 and all(r["slot"] == 0 for r in rows) and len({r["shard"] for r in rows}) == 2
    assert sharding.interleave(df.filter("false")).count() == 0
