import hashlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from kpiloom.llm import byte_bpe, decontamination, language_id, simhash, toxicity
from tests.llm.test_decontamination import brute as brute_overlaps
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages_against_brute_force(spark, sf):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    bad = {r["doc_id"] for r in toxicity.score_documents(spark, docs, labels).filter("toxic_score >= 0.7").collect()}
    kept = stages["toxicity"](spark, docs, sf)
    assert kept.columns == docs.columns and bad and ids(kept) == ids(docs) - bad

    spoken = stages["language_id"](spark, docs, sf)
    rejected = {r["doc_id"] for r in language_id.identify(spark, docs).filter("language_id.lang = 'und' or language_id.score < 0.4").collect()}
    assert spoken.columns == docs.columns and ids(spoken) == ids(docs) - rejected and len(rejected) <= 0.01 * docs.count()

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    component = brute_components([(d, brute_fingerprint(t)) for d, t in texts.items()])
    single = stages["simhash_near_dedup"](spark, docs, sf)
    assert single.columns == docs.columns and ids(single) == set(component.values()) and single.count() == len(set(component.values()))

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = stages["benchmark_decontamination"](spark, docs, sf)
    short = {d: t for d, t in texts.items() if len(t) < 6000}  # all alignments of long texts take too long here
    leaked = {d for d, _ in brute_overlaps(list(short.items()), items)}
    assert leaked and clean.columns == docs.columns and ids(clean) & set(short) == set(short) - leaked

    enc = byte_bpe.encoding(byte_bpe.RANK_FILE)
    final = corpus_pipeline.run(spark, sf).collect()
    assert len(final) == len({r["doc_id"] for r in final}) > 0
    assert {r["doc_id"] for r in final} <= ids(docs) - bad - leaked
    for r in final:
        t = enc.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(t), hashlib.sha256(np.array(t, "<u4").tobytes()).hexdigest())


def test_awkward_documents(spark, sf, tmp_path):
    base = spark.read.parquet(f"{sf}/documents.parquet").limit(80)
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", None, None, None), (None, "the and of " * 20, "en", "s", 1), (9003, "the of and " * 9000, None, "s", 1),
                                 (9004, "the one and only", "en", "s", 1), (9004, "the one and only", "en", "s", 1), (9004, "another text of that id", "en", "s", 1)], base.schema)
    base.unionByName(odd).withColumn("fp", base["doc_id"] * 0).withColumn("h", base["doc_id"] * 0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert 9001 not in got and 9002 not in got and 9003 in got and got.count(9004) == 1 and got.count(None) == 1
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").filter("false").write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_no_column_of_the_documents_clashes(spark, sf, tmp_path):
    """An extra column of every name that a stage uses for itself comes back as it was."""
    names = ["fp", "group", "n", "score", "toxic_score", "language_id", "row", "h", "_language", "_key", "_block", "_possible", "_w0", "_w7", "_k_doc_id",
             "_k_text_hash", "_group", "_fp", "_n", "__key", "__w0", "___w0"]
    base = spark.read.parquet(f"{sf}/documents.parquet").limit(60).select("doc_id", "text", "lang")
    lone = base.limit(3).withColumn("doc_id", F.lit(None).cast("bigint"))
    docs = base.unionByName(lone).unionByName(base.limit(2)).select("*", *(F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs, benchmark = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    for rows in (language_id.with_known_language(spark, docs), simhash.deduplicated(docs), decontamination.clean(docs, benchmark)):
        assert rows.columns == docs.columns
        found = rows.collect()
        assert found and all(r[n] == f"{n}:{'-' if r['doc_id'] is None else r['doc_id']}" for r in found for n in names)
