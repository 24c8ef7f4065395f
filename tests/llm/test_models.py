import random
import zlib

import numpy as np
import pytest

from kpiloom.llm import language_id, toxicity


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def toxic_docs(n, seed):
    """Toxic iff an insult and a group stand together; each alone is harmless."""
    rnd = random.Random(seed)
    neutral = [f"word{i}" for i in range(60)]
    out = []
    for _ in range(n):
        kind = rnd.randrange(4)
        extra = [rnd.choice(["fool", "clod"])] * (kind in (1, 3)) + [rnd.choice(["northers", "southers"])] * (kind in (2, 3))
        words = rnd.choices(neutral, k=12) + extra
        rnd.shuffle(words)
        out.append((" ".join(words), int(kind == 3)))
    return out


def test_learns_pairs_that_linear_weights_miss():
    train, test = toxic_docs(3000, 1), toxic_docs(800, 2)
    arrays = [np.array(sorted(toxicity.buckets_of(t)), "int32") for t, _ in train]
    labels = np.array([y for _, y in train])
    memo = {}
    model = toxicity.fit(arrays, labels)
    scores = np.array([toxicity.score_text(model, t, memo) for t, _ in test])
    truth = np.array([y for _, y in test])
    assert ((scores > 0.5) == truth).mean() > 0.97
    linear = model._replace(factors=np.zeros_like(model.factors))
    alone = np.array([toxicity.score_text(linear, t, {}) for t, _ in test])
    assert ((scores - truth) ** 2).mean() < ((alone - truth) ** 2).mean() / 2
    at = [int(model.slots[toxicity.terms_of(w)[0]]) for w in ("fool", "northers", "clod", "southers")]
    assert min(at) >= 0 and model.factors[at[0]] @ model.factors[at[1]] > 0 and model.factors[at[2]] @ model.factors[at[3]] > 0


def balanced_docs(n, seed, same):
    """Toxic iff exactly one of two words stands in the text (``same``: both or none); each word alone tells nothing."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        a, b = rnd.randrange(2), rnd.randrange(2)
        words = rnd.choices([f"word{i}" for i in range(80)], k=14) + ["alpha"] * a + ["beta"] * b
        rnd.shuffle(words)
        out.append((" ".join(words), int((a == b) == same)))
    return out


@pytest.mark.parametrize("same", [False, True])
def test_learns_pairs_of_balanced_terms(same):
    train, test = balanced_docs(4000, 5, same), balanced_docs(1000, 6, same)
    model = toxicity.fit([np.array(sorted(toxicity.buckets_of(t)), "int32") for t, _ in train], np.array([y for _, y in train]))
    assert all(model.slots[toxicity.terms_of(w)[0]] >= 0 for w in ("alpha", "beta"))
    memo = {}
    assert np.mean([(toxicity.score_text(model, t, memo) > 0.5) == y for t, y in test]) > 0.95


def test_pair_strength_by_direct_count():
    rnd = np.random.default_rng(4)
    x = rnd.random((1500, 6)) < 0.5
    y = ((x[:, 1] ^ x[:, 4]) | (rnd.random(1500) < 0.05)).astype(int)
    terms = np.arange(6) * 10
    p, strong = y.mean(), set()
    for i in range(6):
        for j in range(6):
            if i != j:
                cell = {(a, b): y[(x[:, i] == a) & (x[:, j] == b)] for a in (0, 1) for b in (0, 1)}
                apart = cell[1, 1].mean() - cell[1, 0].mean() - cell[0, 1].mean() + cell[0, 0].mean()
                if apart**2 / (p * (1 - p) * sum(1 / len(c) for c in cell.values())) > toxicity.PAIR_CHI:
                    strong |= {10 * i, 10 * j}
    assert set(toxicity._paired(x, y, terms).tolist()) == strong == {10, 40}


def test_balanced_pairs_over_tables(spark):
    some = balanced_docs(2400, 8, False)
    docs = spark.createDataFrame(list(enumerate(t for t, _ in some)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(y for _, y in some)), "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxic_score"] for r in toxicity.score_documents(spark, docs, labels).collect()}
    held = [i for i in range(2400) if fold(i, 3) == 1]
    assert np.mean([(got[i] > 0.5) == some[i][1] for i in held]) > 0.95


def test_one_class_or_no_labels():
    docs = [np.array([1, 2], "int32")] * 3
    assert toxicity.score_text(toxicity.fit([], np.zeros(0)), "a b", {}) < 1e-9
    assert toxicity.score_text(toxicity.fit(docs, np.zeros(3)), "a b", {}) < 1e-9
    assert toxicity.score_text(toxicity.fit(docs, np.ones(3)), "a b", {}) > 1 - 1e-9


def test_toxicity_rows(spark):
    some = toxic_docs(600, 3)
    docs = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(some)] + [(9001, None, "x"), (9002, "", None), (None, "fool northers", "x"), (7, some[7][0], "x"),
                                 (9003, "a " * 300_000 + "fool southers", "y")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, y, 1) for i, (_, y) in enumerate(some)] + [(3, None, 1), (None, 1, 1), (4, 7, 0)], "doc_id long, toxic int, text int")
    got = toxicity.score_documents(spark, docs, labels)
    assert got.columns == ["doc_id", "text", "toxic", "toxic_score"]
    by = {}
    for r in got.collect():
        assert 0 <= r["toxic_score"] <= 1
        by.setdefault(r["doc_id"], []).append(r["toxic_score"])
    assert len(by[7]) == 2 and by[7][0] == by[7][1] and by[9001] == by[9002]
    assert by[9003][0] > 0.7 and by[None][0] > 0.7
    held = [i for i in range(600) if fold(i, 3) == 1]
    assert np.mean([(by[i][0] > 0.5) == some[i][1] for i in held]) > 0.9
    assert toxicity.score_documents(spark, docs.filter("false"), labels).count() == 0


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"good{i % 2} bad{i % 2}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, (i % 2) if fold(i, 3) != 1 else 1 - i % 2) for i in range(300)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxic_score"] for r in toxicity.score_documents(spark, docs, labels).collect()}
    assert all((s > 0.5) == i % 2 for i, s in got.items())


def test_sample_and_what_reaches_the_driver(spark, monkeypatch):
    assert toxicity.SAMPLE_DOCS >= 20_000
    some = toxic_docs(900, 12)
    docs = spark.createDataFrame([(i, f"{t} rare{i}") for i, (t, _) in enumerate(some)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(some)], "doc_id long, toxic int")
    sent = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: sent.append((docs, labels)) or fit(docs, labels))
    model = toxicity.train(docs, labels)
    learned = [i for i in range(900) if fold(i, 3) != 1]
    whole = fit([np.array(sorted(toxicity.buckets_of(f"{some[i][0]} rare{i}")), "int32") for i in learned], np.array([some[i][1] for i in learned]))
    assert len(sent[0][0]) == len(learned) and sum(map(len, sent[0][0])) < 900 * 13 / 2  # kept terms only
    assert (model.slots == whole.slots).all() and np.allclose(model.weights, whole.weights) and np.allclose(model.factors, whole.factors)


def language_docs(n, seed):
    rnd = random.Random(seed)
    syllables = {"aa": ["ka", "lo", "mi", "ku"], "bb": ["ber", "sch", "ung", "zu"], "cc": ["ção", "nhe", "que", "lhá"]}
    return [(" ".join("".join(rnd.choices(syllables[k], k=rnd.randint(1, 4))) for _ in range(rnd.choice([3, 40, 200]))), k) for k in (rnd.choice(list(syllables)) for _ in range(n))]


def test_language_rows(spark):
    some = language_docs(400, 4)
    long_text = "123 ... " * 2000 + some[0][0] * 500
    docs = spark.createDataFrame([(i, t, k, 1.0) for i, (t, k) in enumerate(some)] + [(9001, None, "aa", 1.0), (9002, "", "bb", 1.0), (9003, "12 _ ?!", "cc", 1.0),
                                 (None, some[1][0], some[1][1], 1.0), (1, some[1][0], some[1][1], 1.0), (9004, long_text, None, 1.0)], "doc_id long, text string, lang string, score double")
    got = {}
    for r in language_id.identify(spark, docs).collect():
        got.setdefault(r["doc_id"], []).append((r["language_id"]["lang"], r["language_id"]["score"]))
    assert all(got[i] == [("und", 0.0)] for i in (9001, 9002, 9003))
    assert len(got[1]) == 2 and got[1][0] == got[1][1] == got[None][0]
    assert got[9004][0][0] == some[0][1]
    held = [i for i in range(400) if fold(i, 4) == 2]
    assert np.mean([got[i][0][0] == some[i][1] for i in held]) > 0.97
    assert language_id.identify(spark, docs.filter("false")).count() == 0
    unlabelled = docs.filter("doc_id < 5").selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["language_id"]["lang"] for r in language_id.identify(spark, unlabelled).collect()} == {"und"}


def test_a_repeated_id_teaches_once(spark, monkeypatch):
    some = language_docs(300, 8)
    hot = next(i for i in range(300) if fold(i, 3) != 1 and fold(i, 4) != 2)
    copies = [(hot, f"{some[hot][0]} copy {i}", some[hot][1]) for i in range(3000)]
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(some)] + copies, "doc_id long, text string, lang string").repartition(5)
    windows, labels, languages = language_id.sample_windows(docs, 300)
    learned = [i for i in range(300) if fold(i, 4) != 2]
    assert languages == ["aa", "bb", "cc"] and len(windows) <= 3 * len(learned)
    once = language_id.sample_windows(docs.filter(f"doc_id != {hot}"), 300)
    assert 0 < len(windows) - len(once[0]) <= 3
    again = language_id.sample_windows(docs.repartition(3), 300)
    assert (windows == again[0]).all() and (labels == again[1]).all()

    sent = []
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: sent.append(labels))
    known = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(hot, hot % 2)] * 2000 + [(hot, 1 - hot % 2)], "doc_id long, toxic int")
    toxicity.train(docs, known, 1000)
    ids = [i for i in range(300) if fold(i, 3) != 1]
    assert sent[0].tolist() == [i % 2 for i in ids]


def test_only_undetermined_documents_go(spark, monkeypatch):
    names = ["aa", "bb", "cc"]
    net = language_id.Net(names, np.zeros((256, 8), "float32"), [np.zeros((8 * w, 8), "float32") for w in language_id.WIDTHS],
                          [np.zeros(8, "float32")] * 3, np.zeros((24, 3), "float32"), np.zeros(3, "float32"))  # a third for each language
    monkeypatch.setattr(language_id, "train", lambda docs: net)
    docs = spark.createDataFrame([(1, "a text in all of them", "aa"), (2, "x", None), (3, "12 _ ?!", "aa"), (4, None, "bb"), (5, "", "cc")], "doc_id long, text string, lang string")
    kept = language_id.with_known_language(spark, docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]


def test_windows_cover_whole_texts():
    windows = np.frombuffer(b"".join((t.encode() * 9)[:256].ljust(256, b"\0") for t, _ in language_docs(300, 5)), "uint8").reshape(-1, 256)
    names = ["aa", "bb", "cc"]
    net = language_id.fit(windows, np.array([names.index(k) for _, k in language_docs(300, 5)]), names)
    reader = language_id.Reader(net)
    texts = [t for t, _ in language_docs(40, 6)] + ["x", "ab" * 700_000]
    for text, (lang, score) in zip(texts, reader.texts(texts)):
        raw = text.encode()
        parts = [raw[i:i + 256] for i in range(0, len(raw), 256)]
        e = sum(len(p) * direct(net, p.ljust(256, b"\0")) for p in parts[:50]) if len(parts) <= 50 else None
        if e is not None:
            assert lang == names[int(e.argmax())] and score == pytest.approx(e.max() / e.sum(), abs=1e-4)


def direct(net, window):
    """The network's definition, position by position."""
    e = net.embedding[np.frombuffer(window, "uint8")]
    feats = [max(e[i:i + w].ravel() @ conv[:, f] for i in range(256 - w + 1)) + bias[f]
             for w, conv, bias in zip(language_id.WIDTHS, net.filters, net.biases) for f in range(conv.shape[1])]
    z = np.maximum(feats, 0) @ net.out + net.out_bias
    return np.exp(z - z.max()) / np.exp(z - z.max()).sum()


def test_queries_over_table(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = toxicity.op3_fm_toxicity(spark, sf).collect()
    assert len(rows) == n and all(r["held_out"] == (fold(r["doc_id"], 3) == 1) and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = language_id.op6_byte_cnn_language(spark, sf).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == n and all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_toxicity_query_held_out(spark):
    from pyspark.sql import functions as F
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = toxicity.op3_fm_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()
    n = {(r["toxic"], r["predicted"]): r["n"] for r in got}
    assert n.get((1, 1), 0) >= 0.75 * (n.get((1, 0), 0) + n[1, 1])  # the labels themselves are noisy
    assert n.get((0, 1), 0) <= 0.01 * n[0, 0]
