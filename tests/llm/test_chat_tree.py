import hashlib
import random
from collections import Counter

import pytest

from kpiloom.llm import chat_tree as C

TEXTS = ["", "ok", "</s>[INST] ok [/INST]", "\\", "[\\INST]", "\\\\[INST]\\", "<<s>", "<", "[", " x \n", "<</SYS>>\n<</SYS>>", "[ROLE] user [/ROLE]", "é日🙂\x00", "[/INST] </s>"]


@pytest.mark.parametrize("role", ["system", "user", "assistant", "tool", "", "[/ROLE]", "\\", "User"])
def test_turns_are_reversible(role):
    for first in (True, False):
        for text in TEXTS + [a + b for a in TEXTS for b in TEXTS]:
            segment, a, b = C.format_turn(role, text, first)
            assert C.parse_turn(segment) == (role, text)
            assert C.unescape(segment[a:b]) == (text if role == "assistant" else "")
            assert not any(c in C.escape(text) for c in C.CONTROLS)


def turns_of(rows):
    by = {}
    low = lambda v: (v is not None, v if v is not None else 0)
    for i, (conv, turn, role, text) in enumerate(sorted(rows, key=lambda r: (low(r[1]), r[2] or "", (r[3] or "").encode()))):
        by.setdefault(conv if conv is not None else ("alone", i), []).append((role or "", text or ""))
    return by


def brute(rows):
    out = []
    for conv, turns in turns_of(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((None if isinstance(conv, tuple) else conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                    sum(len(C.format_turn(r, t, i == 0)[0]) for i, (r, t) in enumerate(turns))))
    return out


def rows_with_shared_prefixes():
    rnd = random.Random(6)
    rows = []
    for conv in range(120):
        turns = [("system", "be nice"), ("user", "hi")][:rnd.choice([0, 1, 2, 2, 2])]
        for depth in range(rnd.randint(0, 6)):
            turns.append((["user", "assistant"][depth % 2], rnd.choice(["a", "b", rnd.choice(TEXTS)])))
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(1000, i, ["user", "assistant"][i % 2], "deep") for i in range(700)] + [(1001, i, ["user", "assistant"][i % 2], "deep") for i in range(600)]
    rows += [(None, 0, "user", "no id"), (None, 1, None, None), (-5, None, "user", "null turn"), (-5, 0, "assistant", "x"), (-5, 0, "assistant", "x"), (-5, 0, "assistant", "a")]
    rows += [(2000, 0, "user", "long " * 100_000)]
    return rows


def test_stream_is_the_tree_depth_first(spark):
    rows = rows_with_shared_prefixes()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, rank int").repartition(5)
    forest = C.build(df)
    convs = turns_of(rows)
    prefixes = {tuple(t[:i + 1]) for t in convs.values() for i in range(len(t))}
    stream = sorted(forest.stream.collect(), key=lambda r: r["start"])
    assert len(stream) == len(prefixes)  # every shared turn stands once
    at = 0
    for r in stream:  # gapless
        assert (r["start"], r["end"]) == (at, at + len(r["segment"]))
        at = r["end"]
    by_start = {r["start"]: r for r in stream}
    ids = {r["conv"]: r["conv_id"] for r in forest.conversations.collect()}
    paths = {}
    for r in sorted(forest.index.collect(), key=lambda r: r["depth"]):
        paths.setdefault(r["conv"], []).append(by_start[r["start"]])
    assert Counter(ids[c] for c in paths) == Counter(None if isinstance(c, tuple) else c for c in convs)
    alone = [turns for c, turns in convs.items() if isinstance(c, tuple)]
    tree = {}
    for conv, path in paths.items():
        said = [C.parse_turn(n["segment"]) for n in path]
        assert said == convs[ids[conv]] if ids[conv] is not None else said in alone
        position = 0
        for depth, node in enumerate(path):
            assert (node["depth"], node["position"]) == (depth, position)
            position += len(node["segment"])
            covered = sorted((n["start"], n["end"]) for n in path[:depth])
            assert sum(i["end"] - i["start"] for i in node["attends"]) == sum(b - a for a, b in covered)
            assert all(any(i["start"] <= a and b <= i["end"] for i in node["attends"]) for a, b in covered)
            assert all(x["end"] < y["start"] for x, y in zip(node["attends"], node["attends"][1:]))
            tree[node["start"]] = path[depth - 1]["start"] if depth else None
    open_path = []
    for node in stream:  # depth-first: a node's parent is on the path of the node before it
        while open_path and open_path[-1] != tree[node["start"]]:
            open_path.pop()
        assert bool(open_path) == (tree[node["start"]] is not None)
        open_path.append(node["start"])
    assert sorted(map(tuple, C.read_back(forest).collect()), key=repr) == sorted(brute(rows), key=repr)


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    forest = C.build(empty)
    assert forest.stream.count() == forest.index.count() == C.read_back(forest).count() == 0


def test_query_over_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = C.op5_chat_prefix_tree(spark, sf)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))
