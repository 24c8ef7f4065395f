"""Benchmark decontamination with spaced seeds.

Texts are compared as lower-cased words of letters and digits.  A mask such as
``11101011`` hashes the words at its ones and ignores those at its zeros, so a
hash survives a substitution at an ignored place.  ``MASKS`` are chosen so
that any ``WINDOW`` aligned words of which at most two differ share a hash
under one of them, at some position.  The hashes of the benchmark's positions
meet those of the documents' positions in a join; each hit fixes an alignment
of item and document, and the words of the whole item are compared along it.
An item contaminates a document if, on some alignment, ``NEED`` of ``WINDOW``
successive words agree.  An item under ``WINDOW`` words needs the same share of
all its words, rounded up: one of 7 to 12 words may differ in one, one of 5 or
6 has to occur unchanged; ``SHORT_SEEDS`` find them all.  An item under
``LEAST_WORDS`` words contaminates nothing.  A character of a script written
without spaces is a word of its own.

All in DataFrame operations.  Positions and hashes are generated and joined in
one narrow stage over the documents, a hit keeps only the part of the text
beside the item, and only verified (document, item) pairs are shuffled.  The
benchmark's hashes are broadcast while there are at most ``BROADCAST_ROWS`` of
them (20 bytes each); for a larger benchmark a blocked Bloom filter of bounded
size takes out nearly all positions, and the rest meets the hashes in a
shuffled join.  Equal items stand as one, with their smallest id, so copies of
an item don't multiply hits; ``members`` lists all ids of each.

Cases: null and empty texts, and texts without a word, contaminate nothing and
are not contaminated; documents with a null id are reported under a null id;
rows that share an id are reported together, as are repeated rows; other
columns are ignored; an empty table on either side gives an empty report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.bloom import left_out, probed
from kpiloom.llm.common import table, written

MASKS = ("11101011", "110100111")
WINDOW, NEED = 13, 11
LEAST_WORDS = 5
# (mask, first word): any item of LEAST_WORDS words or more unchanged, and of 7 or more with one word changed, has one of these
SHORT_SEEDS = (("11111", 0), ("11111", 2), ("1100111", 0), ("1111", 0))
SHORT_MASKS = tuple(dict.fromkeys(m for m, _ in SHORT_SEEDS))
# the ranges hold all of those scripts; looked for first, as they are told apart much faster than scripts
MAYBE_NO_SPACES = (r"[\x{E00}-\x{109F}\x{1780}-\x{19FF}\x{2E80}-\x{AA7F}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}"
                   r"\x{16FE0}-\x{1B2FF}\x{1F200}\x{20000}-\x{3FFFF}]")
NO_SPACES = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}])"
BROADCAST_ROWS = 2_000_000


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    text = F.when(text.rlike(MAYBE_NO_SPACES), F.regexp_replace(text, NO_SPACES, " $1 ")).otherwise(text)
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def mask_hash(tokens: Column, at: Column, mask: str) -> Column:
    """Hash of the words under the mask's ones at position ``at``."""
    return F.xxhash64(F.lit(mask), *(F.get(tokens, at + i) for i, one in enumerate(mask) if one == "1"))


def _items(benchmark: DataFrame) -> DataFrame:
    return (benchmark.select(F.col("item_id"), words(F.col("text")).alias("item"))
            .filter(F.size("item") >= LEAST_WORDS).groupBy("item").agg(F.min("item_id").alias("item_id"))
            .select(F.xxhash64("item").alias("item_key"), "item_id", "item"))


def members(benchmark: DataFrame) -> DataFrame:
    """(item_id, member_id): of every item that can be reported, the id it is reported under and its own."""
    own = benchmark.select(F.col("item_id").alias("member_id"), words(F.col("text")).alias("item")).filter(F.size("item") >= LEAST_WORDS)
    return own.join(_items(benchmark).select("item", "item_id"), "item").select("item_id", "member_id").distinct()


def _seeds(items: DataFrame) -> DataFrame:
    """(h, item_key, q): the hashes of each item's positions."""
    n = F.size("item")

    def seed(mask: str):
        return lambda q: F.struct(mask_hash(F.col("item"), q, mask).alias("h"), q.alias("q"))

    long = [F.transform(F.sequence(F.lit(0), n - len(m)), seed(m)) for m in MASKS]
    short = F.filter(F.array(*(F.when(n >= q + len(m), seed(m)(F.lit(q))) for m, q in SHORT_SEEDS)), lambda x: x.isNotNull())
    places = F.when(n >= WINDOW, F.concat(*long)).otherwise(short)
    return items.select("item_key", F.inline(places)).distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, keys: list[str], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``keys`` of ``docs`` (which has them and ``text``) with item_id,
    words_matched of the best window, its length, its first word in document
    and item, and aligned_matched: the words that agree over the whole item."""
    items = written(_items(benchmark), "benchmark-items")
    seeds = written(_seeds(items), "benchmark-seeds")
    masks = [*MASKS, *(SHORT_MASKS if items.filter(F.size("item") < WINDOW).head(1) else [])]
    own = docs.select(*keys, F.xxhash64("text").alias("row"), words(F.col("text")).alias("doc"))
    last = F.size("doc") - LEAST_WORDS
    at = own.select("*", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("p"))
    at = at.select("*", F.explode(F.array(*(mask_hash(F.col("doc"), F.col("p"), m) for m in masks))).alias("h"))
    if seeds.count() <= broadcast_rows:
        hits = at.join(F.broadcast(seeds), "h").join(F.broadcast(items), "item_key")
    else:
        places = probed(at.select(*keys, "row", "p", "h"), seeds.select("h").distinct(), "h").filter("_possible")
        places = places.join(seeds, "h").select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("row").alias("_row"), "p", "q", "item_key").distinct()
        same = F.col("row") == F.col("_row")
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        hits = own.join(places, same).join(items, "item_key")

    # of successive hits on one alignment the first is enough: skip those whose predecessor is a hit of the first mask
    follows = F.lit(True)
    for i, one in enumerate(MASKS[0]):
        if one == "1":
            follows &= F.get("doc", F.col("p") + (i - 1)).eqNullSafe(F.get("item", F.col("q") + (i - 1)))
    offset = F.col("p") - F.col("q")
    skipped = F.greatest(-offset, F.lit(0))
    hits = hits.filter((F.col("p") == 0) | (F.col("q") == 0) | ~follows | (F.size("item") < WINDOW)).select(
        *keys, "item_id", "item", offset.alias("o"), skipped.alias("skipped"),
        F.slice("doc", F.greatest(offset, F.lit(0)) + 1, F.size("item") - skipped).alias("part"))
    # written, so that a hit goes on with the part of the text beside the item and not with the text
    hits = written(hits, "benchmark-hits")

    n, width = F.size("item"), F.least(F.size("item"), F.lit(WINDOW))
    need = F.ceil(width * NEED / WINDOW).cast("int")
    agree = F.transform("item", lambda word, k: F.when(F.get("part", k - F.col("skipped")) == word, 1).otherwise(0))
    hits = hits.select(*keys, "item_id", "o", width.alias("width"), need.alias("need"), agree.alias("agree"))
    total = F.aggregate("agree", F.lit(0), lambda a, x: a + x)
    hits = hits.withColumn("aligned", total).filter("aligned >= need")
    windows = F.transform(F.sequence(F.lit(0), F.size("agree") - F.col("width")), lambda i: F.struct(
        F.aggregate(F.slice("agree", i + 1, F.col("width")), F.lit(0), lambda a, x: a + x).alias("matched"), (-i).alias("first")))
    hits = hits.withColumn("best", F.array_max(windows)).filter("best.matched >= need")
    best = F.max(F.struct("best.matched", "aligned", "best.first", (-F.col("o")).alias("o"), "width")).alias("b")
    return hits.groupBy(*keys, "item_id").agg(best).select(
        *keys, "item_id", F.col("b.matched").alias("words_matched"), F.col("b.width").alias("window_words"),
        (-F.col("b.o") - F.col("b.first")).alias("doc_word"), (-F.col("b.first")).alias("item_word"), F.col("b.aligned").alias("aligned_matched"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with the columns of ``docs``."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    hit = written(overlaps(keyed, benchmark, ["doc_id", "text_hash"]).select("doc_id", "text_hash").distinct(), "contaminated")
    return left_out(docs, hit, {"doc_id": F.col("doc_id"), "text_hash": F.xxhash64("text")})


def op2_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and item, equal items each with their own."""
    benchmark = table(spark, sf_dir, "benchmark")
    found = overlaps(table(spark, sf_dir, "documents").select("doc_id", "text"), benchmark, ["doc_id"])
    return found.join(members(benchmark), "item_id").withColumn("item_id", F.col("member_id")).select(found.columns)
