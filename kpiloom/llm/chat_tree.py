"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share those turns' tokens (here
code points of the formatted text): the tree of all conversations is written
once, depth-first, as one stream of characters.  Each node (a turn after
certain turns) has its place in the stream, the position ids of a conversation
read alone (they restart at the root), the intervals of the stream in which its
ancestors stand, which are what it attends to besides itself, and the part
that counts for the loss.

1. Turns are dealt by conversation and sorted; one pass formats each turn and
   gives it a key, a digest of all turns up to it.  Nothing is gathered: a
   conversation of any length streams through.
2. Distinct leaves are sorted by their path of keys.  In that order every
   subtree is contiguous, so a node belongs to the first leaf beneath it, and
   (leaf, depth) is the depth-first order.
3. The places of nodes are running sums in that order: within a leaf, within a
   range of leaves, and over the ranges.
4. One conversation a leaf goes through its nodes by depth, keeps the
   intervals of the path, merged where they touch, and emits the nodes that
   belong to its leaf.
5. The index lists the nodes of every conversation.  Reading back joins it with
   the stream and streams through each conversation again.

A turn that very many conversations share is one node; it is found with a
grouped minimum (combined before the shuffle) and joined with plain joins whose
other side Spark can split.

Template: ``<s>`` opens a conversation; system turns stand between
``<<SYS>>`` and ``<</SYS>>``, user turns between ``[INST]`` and ``[/INST]``,
assistant turns end in ``</s>``, and any other role is named between
``[ROLE]`` and ``[/ROLE]``.  In texts a backslash is doubled, and a control
string gets a backslash after its first character, so none occurs there.

Cases: a null text or role is an empty one; an empty role is a role by its
name; every row without a conv_id is a conversation of one turn without an id,
dealt on its own, since nothing says which of them belong together; turns with
equal numbers are ordered by role and text, null numbers first, and repeated
rows are turns of their own; other columns are ignored; an empty table gives
an empty stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import table, written

# The control strings of the template.
BEGIN, END = "<s>", "</s>"
SYSTEM, SYSTEM_END = "<<SYS>>", "<</SYS>>"
USER, USER_END = "[INST]", "[/INST]"
ROLE, ROLE_END = "[ROLE]", "[/ROLE]"
CONTROLS = (BEGIN, END, SYSTEM, SYSTEM_END, USER, USER_END, ROLE, ROLE_END)

BATCH_ROWS = 2000
BATCH_CHARS = 4_000_000
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_SEGMENT = re.compile(
    rf"(?:{re.escape(BEGIN)})?(?:{re.escape(SYSTEM)}\n(?P<system>.*)\n{re.escape(SYSTEM_END)}\n"
    rf"|{re.escape(USER)} (?P<user>.*) {re.escape(USER_END)}"
    rf"|{re.escape(ROLE)} (?P<role>.*) {re.escape(ROLE_END)}(?P<other>.*) {re.escape(END)}"
    rf"| (?P<assistant>.*) {re.escape(END)})", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def format_turn(role: str, text: str, first: bool) -> tuple[str, int, int]:
    """The turn's part of the formatted text, and the range in it that counts for the loss."""
    body = escape(text)
    before, after = {"system": (f"{SYSTEM}\n", f"\n{SYSTEM_END}\n"), "user": (f"{USER} ", f" {USER_END}"), "assistant": (" ", f" {END}")}.get(
        role, (f"{ROLE} {escape(role)} {ROLE_END}", f" {END}"))
    before = BEGIN * first + before
    return before + body + after, len(before), len(before) + len(body) * (role == "assistant")


def parse_turn(segment: str) -> tuple[str, str]:
    """Role and text of a turn's part."""
    found = _SEGMENT.fullmatch(segment)
    if found is None:
        raise ValueError(f"not a formatted turn: {segment[:80]!r}")
    if found["other"] is not None:
        return unescape(found["role"]), unescape(found["other"])
    return found.lastgroup, unescape(found[found.lastgroup])


class Forest(NamedTuple):
    stream: DataFrame  # one row a node
    index: DataFrame  # conv, depth, start: the nodes of every conversation
    conversations: DataFrame  # conv, conv_id


class _Rows:
    """Collects rows into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.chars = schema, [], 0

    def add(self, row: tuple, chars: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= BATCH_ROWS or self.chars >= BATCH_CHARS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
        self.rows, self.chars = [], 0


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


_CHAIN = pa.schema([("conv", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("role", pa.string()),
                    ("segment", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("n_chars", pa.int64()), ("position", pa.int64()), ("path", pa.binary())])
_CHAIN_SQL = ("conv long, conv_id long, depth long, key binary, parent binary, role string, segment string, loss_start long, loss_end long, "
              "n_chars long, position long, path binary")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formatted turns with keys, from rows sorted by conversation and turn;
    the last turn of a conversation also has the path of keys to it."""
    out, conv = _Rows(_CHAIN), TaskContext.get().partitionId() << 33
    held: tuple | None = None
    path: list[bytes] = []
    for conv_id, role, text in _rows(batches):
        fresh = held is None or conv_id is None or held[1] != conv_id
        if held is not None:
            yield from out.add((*held, b"".join(path) if fresh else None), len(held[6]))
            conv += fresh
        depth, parent, position = (0, b"", 0) if fresh else (held[2] + 1, held[3], held[10] + held[9])
        path = [] if fresh else path
        segment, a, b = format_turn(role, text, fresh)
        name = role.encode()
        key = hashlib.sha256(parent + len(name).to_bytes(4, "little") + name + text.encode()).digest()[:16]
        path.append(key[:8])
        held = (conv, conv_id, depth, key, parent, role, segment, a, b, len(segment), position)
    if held is not None:
        yield from out.add((*held, b"".join(path)))
    yield from out.flush()


_STREAM = pa.schema([("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()), ("depth", pa.int64()), ("role", pa.string()), ("segment", pa.string()),
                     ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attends", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
_STREAM_SQL = ("start long, end long, position long, depth long, role string, segment string, loss_start long, loss_end long, "
               "attends array<struct<start: long, end: long>>")


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream rows, from the nodes of leaves sorted by (leaf, depth)."""
    out, leaf = _Rows(_STREAM), None
    above: list[list[int]] = []
    for rank, owner, start, position, depth, role, segment, a, b in _rows(batches):
        if rank != leaf:
            leaf, above = rank, []
        end = start + len(segment)
        if owner == rank:
            yield from out.add((start, end, position, depth, role, segment, start + a, start + b, [{"start": x, "end": y} for x, y in above]), len(segment))
        if above and above[-1][1] == start:
            above[-1][1] = end
        else:
            above.append([start, end])
    yield from out.flush()


def build(conversations: DataFrame) -> Forest:
    """The forest of ``conversations`` (conv_id, turn, role, text)."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text"), F.lit("")).alias("text"))
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    chain = written(turns.repartition("conv_id", own).sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
                    .mapInArrow(_chain, _CHAIN_SQL), "chat-turns")
    ends = chain.filter("path is not null").select("conv", "conv_id", F.col("key").alias("leaf"), "path")
    leaves = (ends.groupBy("leaf", "path").agg(F.min("conv").alias("speaker"))
              .repartitionByRange("path").sortWithinPartitions("path").select("leaf", "speaker", F.monotonically_increasing_id().alias("rank")))
    leaves = written(leaves, "chat-leaves")
    convs = written(ends.select("conv", "leaf").join(leaves, "leaf").select("conv", "rank", (F.col("conv") == F.col("speaker")).alias("speaks")), "chat-ranks")

    nodes = (chain.select("conv", "key", "depth", "n_chars").join(convs, "conv")
             .groupBy("key").agg(F.min("rank").alias("owner"), F.min("depth").alias("depth"), F.min("n_chars").alias("n_chars")))
    nodes = written(nodes, "chat-nodes")
    before = lambda c, w: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(c)
    owners = nodes.groupBy("owner").agg(F.sum("n_chars").alias("chars")).withColumn("range", F.shiftright("owner", 33))
    ranges = owners.groupBy("range").agg(F.sum("chars").alias("all")).select("range", before("all", Window.orderBy("range")).alias("base"))
    owners = (owners.withColumn("within", before("chars", Window.partitionBy("range").orderBy("owner"))).join(ranges, "range")
              .select("owner", (F.col("base") + F.col("within")).alias("base")))
    starts = written(nodes.withColumn("within", before("n_chars", Window.partitionBy("owner").orderBy("depth"))).join(owners, "owner")
                     .select("key", "owner", (F.col("base") + F.col("within")).alias("start")), "chat-starts")

    told = chain.drop("conv_id", "path", "parent", "n_chars").join(convs.filter("speaks").select("conv", "rank"), "conv").join(starts, "key")
    stream = (told.repartition("rank").sortWithinPartitions("rank", "depth")
              .select("rank", "owner", "start", "position", "depth", "role", "segment", "loss_start", "loss_end").mapInArrow(_emit, _STREAM_SQL))
    index = chain.select("conv", "depth", "key").join(starts.select("key", "start"), "key").select("conv", "depth", "start")
    return Forest(written(stream, "chat-stream"), written(index, "chat-index"), ends.select("conv", "conv_id"))


_READ = pa.schema([("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_READ_SQL = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation, from its nodes sorted by depth."""
    out, current = _Rows(_READ), None
    turns = loss = hashlib.sha256()
    n = loss_chars = chars = 0
    for conv, segment, a, b in _rows(batches):
        if conv != current:
            if current is not None:
                yield from out.add((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            current, turns, loss, n, loss_chars, chars = conv, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        role, text = parse_turn(segment)
        turns.update(f"{role}\n{text}\n".encode())
        counted = unescape(segment[a:b])
        loss.update(counted.encode())
        n, loss_chars, chars = n + 1, loss_chars + len(counted), chars + len(segment)
    if current is not None:
        yield from out.add((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
    yield from out.flush()


def read_back(forest: Forest) -> DataFrame:
    """Per conversation, what its nodes in the stream say."""
    parts = (forest.index.join(forest.stream.select("start", "segment", (F.col("loss_start") - F.col("start")).alias("a"), (F.col("loss_end") - F.col("start")).alias("b")), "start")
             .repartition("conv").sortWithinPartitions("conv", "depth").select("conv", "segment", "a", "b"))
    return parts.mapInArrow(_digest, _READ_SQL).join(forest.conversations, "conv").select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op5_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = f"{END}{USER} ok {USER_END}"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(build(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)))
