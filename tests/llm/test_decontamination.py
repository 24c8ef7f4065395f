import random
import re
from itertools import combinations

import pytest

from kpiloom.llm import decontamination as D


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items):
    """(doc_id, item_id) by comparing every alignment of every pair."""
    known = {}
    for i, t in items:
        w = tuple(tokens(t))
        if len(w) >= D.LEAST_WORDS:
            known[w] = i if w not in known else min(known[w], i)
    out = set()
    for d, t in docs:
        doc = tokens(t)
        for item, i in known.items():
            n = len(item)
            width, need = min(n, D.WINDOW), D.NEED if n >= D.WINDOW else n
            for o in range(-n, len(doc) + 1):
                agree = [int(0 <= o + k < len(doc) and doc[o + k] == item[k]) for k in range(n)]
                if max(sum(agree[j:j + width]) for j in range(n - width + 1)) >= need:
                    out.add((d, i))
                    break
    return out


def test_masks_find_any_two_substitutions():
    for wrong in combinations(range(D.WINDOW), 2):
        assert any(not {s + i for i, one in enumerate(m) if one == "1"} & set(wrong) for m in D.MASKS for s in range(D.WINDOW - len(m) + 1))


def cases():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    draw = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(n))) for i, n in enumerate([13, 14, 20, 37, 59, 12, 7, 5, 4, 1])]
    items += [(20, items[2][1]), (21, "De " * 30), (22, None), (23, ""), (24, "?!"), (25, "È ç-ñ, " * 6)]
    docs = []
    for i, t in items:
        w = tokens(t)
        for kind in range(5):
            body = list(w)
            if kind in (1, 2) and len(w) >= 13:  # two, then four of thirteen words differ
                for j in rnd.sample(range(13), 2 * kind):
                    body[j::13] = ["zz"] * len(body[j::13])
            if kind == 3:
                body = body[len(body) // 3:]
            if kind == 4:
                body = body[:len(body) // 2] + ["inserted"] + body[len(body) // 2:]
            text = " ".join(draw(rnd.randint(0, 9)) + body + draw(rnd.randint(0, 9)))
            docs.append((len(docs), text.upper() if kind == 1 else text.replace(" ", ", ") if kind == 2 else text))
    docs += [(len(docs) + i, t) for i, t in enumerate([None, "", "...", "De", "de " * 3000, " ".join(draw(3000)) + " " + items[3][1]])]
    return docs, items


@pytest.mark.parametrize("broadcast_rows", [D.BROADCAST_ROWS, 0])
def test_against_all_alignments(spark, broadcast_rows):
    docs, items = cases()
    extra = [(None, items[3][1]), (3, docs[3][1])]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs + extra], "doc_id long, text string, h string, item_id int").repartition(3)
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc string")
    rows = D.overlaps(df, bench, ["doc_id"], broadcast_rows).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == brute(docs + extra, items)
    assert len(rows) == len({(r["doc_id"], r["item_id"]) for r in rows})
    texts = dict(docs)
    for r in rows:
        if r["doc_id"] is not None:
            doc, item = tokens(texts[r["doc_id"]]), tokens(dict(items)[r["item_id"]])
            span = range(r["window_words"])
            a, b = r["doc_word"], r["item_word"]
            assert sum(0 <= a + k < len(doc) and doc[a + k] == item[b + k] for k in span) == r["words_matched"]
    bad = {d for d, _ in brute(docs + extra, items)}
    kept = D.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs + extra if d not in bad)
    assert D.overlaps(df.filter("false"), bench, ["doc_id"]).count() == D.overlaps(df, bench.filter("false"), ["doc_id"]).count() == 0


def test_short_items_scripts_without_spaces_and_equal_items(spark, tmp_path):
    items, docs, want = [], [], set()
    for n in range(5, 13):
        body = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(body)))
        for at in range(n + 1):  # one word changed, none at the end
            one = ["zz" if k == at else w for k, w in enumerate(body)]
            docs.append((100 * n + at, "before " + " ".join(one) + " after"))
            docs.append((5000 + 100 * n + at, " ".join(w for k, w in enumerate(one) if k or at)))  # at a text's start, or its first word cut off
            if at == n or n >= 7:
                want |= {(100 * n + at, n), (5000 + 100 * n + at, n)}
    long = "\u6c34\u706b\u6728\u91d1\u571f\u65e5\u6708\u661f\u98a8\u96f2\u96e8\u96ea\u5c71\u5ddd\u6d77\u7530"
    items += [(50, long), (51, long), (52, items[0][1])]
    docs += [(9000, "\u4eba" * 4 + long[:8] + "\u7a7a" + long[9:] + "\u4eba"), (9001, long[:8] + "\u4eba" * 9)]
    want |= {(9000, 50), (9000, 51), *((d, 52) for d, i in want if i == 5)}
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [(r["doc_id"], r["item_id"]) for r in D.op2_spaced_seed_decontamination(spark, str(tmp_path)).collect()]
    assert set(got) == want and len(got) == len(want)


def test_query_over_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    planted = {(d, i) for d, t in docs for i, b in items if " ".join(tokens(b)) in " ".join(tokens(t))}
    found = {(r["doc_id"], r["item_id"]) for r in D.op2_spaced_seed_decontamination(spark, sf).collect()}
    assert planted and planted <= found
    df = D.op2_spaced_seed_decontamination(spark, sf)
    assert "Python" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("max_blocks", [1, 1 << 10])
def test_left_out_equals_null_safe_anti_join(spark, max_blocks, monkeypatch):
    from pyspark.sql import functions as F

    from kpiloom.llm import bloom
    monkeypatch.setattr(bloom.probed, "__defaults__", (max_blocks,))
    rows = [(i % 40 if i % 9 else None, f"t{i % 7}" if i % 5 else None) for i in range(200)]
    keys = [(i, f"t{i % 7}") for i in range(0, 40, 3)] + [(None, "t1"), (None, None), (4, None), (4, None)]
    left = spark.createDataFrame(rows, "a int, b string").selectExpr("a as x", "b as y", "1 as _key")
    right = spark.createDataFrame(keys, "a int, b string")
    got = sorted(map(str, ((r["x"], r["y"]) for r in bloom.left_out(left, right, {"a": F.col("x"), "b": F.col("y")}).collect())))
    assert got == sorted(str(r) for r in rows if r not in set(keys))
