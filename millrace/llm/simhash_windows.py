"""Benchmark decontamination by SimHash over item-sized windows, in native functions only.

Texts are lower-cased and cut into words of letters and digits; a shingle is
``width`` words (all words where an item has fewer), its weight the number of
times it occurs.  A document matches an item if a window of the item's number of
words (the whole document, if shorter) has a weighted Jaccard similarity of
``least`` or more with the item.

Finding the windows: a similar window holds at least ``least`` of the item's
shingles.  So among any floor((1 - least) * shingles) + 1 of them, the item's
anchors, one is in the window, and only windows around an anchor's place are
formed; none that could match is lost.  Anchors are the shingles with the
longest words, looked up by that word while the text is read.

Deciding: each window gets a 64-bit SimHash.  Fingerprints are cut into
``radius + 1`` blocks, of which two within the radius share one at least (the
pigeonhole); windows meet their item's fingerprint by block, the Hamming
distance is checked, and the exact similarity of those left decides.  At the
limit of 0.8 the distance has mean 9.7 and deviation 2.9, so the radius of 24
stands five deviations off.

Anchors are broadcast in blocks of at most ``block_rows`` rows, each joined
against all documents, so a larger benchmark costs passes, not memory.

Nulls and edges: NULL and empty texts match nothing, nor does an item without
words; rows that repeat give one row, items that repeat are separate; ties of
windows go to the earliest; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import documents, staged, table

BITS = 64
_LANES = 0x0000000100000001  # two counters of 32 bits in a number


def words(text: Column) -> Column:
    """Lower-case words of letters and digits, in order."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _hash(all_words: Column, start: Column, width: Column) -> Column:
    """The hash of the shingle that starts at a 0-based place."""
    return F.xxhash64(F.slice(all_words, start + 1, width))


def shingles(all_words: Column, width: Column) -> Column:
    n = F.size(all_words) - width + 1
    return F.when(n >= 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: _hash(all_words, i, width))).otherwise(F.array().cast("array<bigint>"))


def with_fingerprint(rows: DataFrame, keys: list[str], hashes: str = "hashes") -> DataFrame:
    """Adds the SimHash of the weighted shingles; ``keys`` tell rows apart.

    A bit is set where more than half of the shingle weight has it set.  Bits j
    and j + 32 are counted in the two halves of one sum.
    """
    each = rows.select(*keys, F.explode(hashes).alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_LANES))).alias(f"lane{j}") for j in range(BITS // 2)]
    counted = each.groupBy(*keys).agg(F.count("*").alias("total"), *sums)
    bit = lambda c, j: F.when(c * 2 > F.col("total"), F.lit(1 << j if j < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("bigint")
    half = 0xFFFFFFFF
    parts = [bit(F.col(f"lane{j}").bitwiseAND(F.lit(half)), j) for j in range(32)] + [bit(F.shiftrightunsigned(f"lane{j}", 32), j + 32) for j in range(32)]
    return counted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), parts).alias("print"))


def blocks(fingerprint: Column, radius: int) -> Column:
    """The fingerprint in radius + 1 runs of bits, as (number, value)."""
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    runs = []
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        runs.append(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits")))
    return F.array(*runs)


def prepared_items(benchmark: DataFrame, width: int) -> DataFrame:
    """(item_id, item, n, width, words, hashes) of items with words; ``item`` numbers the rows of the written table."""
    d = benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    d = d.select("item", "item_id", "words", F.size("words").alias("n"), F.least(F.lit(width), F.size("words")).alias("width"))
    return staged(d.withColumn("hashes", shingles(F.col("words"), F.col("width"))), "items")


def anchors(items: DataFrame, least: float) -> DataFrame:
    """(word, item, n, width, before, hash): shingles of which a similar window holds one; ``before`` words stand ahead of ``word``."""
    def of(i):
        part = F.transform(F.slice("words", i + 1, F.col("width")), lambda w, k: F.struct(F.length(w).alias("length"), w.alias("word"), k.alias("before")))
        return F.struct(F.array_max(part).alias("key"), F.element_at("hashes", i + 1).alias("hash"))

    every = F.transform(F.sequence(F.lit(0), F.size("hashes") - 1), of)
    needed = (F.floor(F.size("hashes") * F.lit(1 - least) + 1e-9) + 1).cast("int")
    chosen = F.slice(F.reverse(F.array_sort(every)), F.lit(1), needed)
    return items.select("item", "n", "width", F.explode(chosen).alias("a")).select("item", "n", "width", F.col("a.key.word").alias("word"), F.col("a.key.before").alias("before"), F.col("a.hash").alias("hash"))


def _overlap(x: Column, y: Column) -> Column:
    """Weight of shingles in both lists."""
    count = lambda a, v: F.size(F.filter(a, lambda e: e == v))
    return F.aggregate(F.array_distinct(y), F.lit(0), lambda acc, v: acc + F.least(count(x, v), count(y, v)))


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 5, least: float = 0.8, radius: int = 24, block_rows: int = 500_000) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, first_word, n_words): the best window of each matching pair."""
    items = prepared_items(benchmark, width)
    anchor = staged(anchors(items, least), "anchors")
    count = anchor.count()
    n_blocks = max(1, -(-count // block_rows))
    text = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words(F.col("text")).alias("doc_words"))
    placed = text.select("doc_id", "text_hash", "doc_words", F.posexplode("doc_words").alias("place", "word"))
    found = []
    for b in range(n_blocks):
        some = anchor.where(F.pmod(F.xxhash64("word"), F.lit(n_blocks)) == b) if n_blocks > 1 else anchor
        at = F.col("place") - F.col("before")
        hit = placed.join(F.broadcast(some), "word").where((at >= 0) & (_hash(F.col("doc_words"), at, F.col("width")) == F.col("hash")))
        low, high = F.greatest(F.lit(0), at + F.col("width") - F.col("n")), F.greatest(F.lit(0), F.least(at, F.size("doc_words") - F.col("n")))
        found.append(hit.select("doc_id", "text_hash", "item", "n", "width", "doc_words", F.sequence(F.least(low, high), high).alias("starts")))
    hits = reduce(DataFrame.unionAll, found)
    near = hits.groupBy("doc_id", "text_hash", "item", "n", "width").agg(F.first("doc_words").alias("doc_words"), F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts"))
    window = near.select("doc_id", "text_hash", "item", "n", "width", "doc_words", F.explode("starts").alias("start")).withColumn("words", F.slice("doc_words", F.col("start") + 1, F.col("n")))
    window = staged(window.select("doc_id", "text_hash", "item", "start", F.size("words").alias("n_words"), shingles(F.col("words"), F.col("width")).alias("hashes")), "windows")

    keys = ["doc_id", "text_hash", "item", "start"]
    prints = with_fingerprint(window, keys).select(*keys, F.col("print"), F.explode(blocks(F.col("print"), radius)).alias("b"))
    of_items = with_fingerprint(items, ["item"]).select(F.col("item").alias("of"), F.col("print").alias("item_print"), F.explode(blocks(F.col("print"), radius)).alias("ib"))
    same = (F.col("item") == F.col("of")) & (F.col("b.block") == F.col("ib.block")) & (F.col("b.bits") == F.col("ib.bits"))
    close = prints.join(of_items, same).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius).select(*keys).distinct()

    exact = window.alias("w").join(close.alias("c"), [F.col(f"w.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys], "left_semi")
    exact = exact.join(items.select("item", "item_id", F.col("hashes").alias("item_hashes")), "item")
    both = _overlap(F.col("hashes"), F.col("item_hashes"))
    similarity = both / (F.size("hashes") + F.size("item_hashes") - both)
    best = exact.select("doc_id", "text_hash", "item", "item_id", "n_words", F.col("start"), similarity.alias("similarity")).where(F.col("similarity") >= least)
    top = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("top")
    return best.groupBy("doc_id", "text_hash", "item", "item_id").agg(top).select(
        "doc_id", "text_hash", "item_id", F.col("top.similarity").alias("similarity"), (-F.col("top.back")).cast("bigint").alias("first_word"), F.col("top.n_words").cast("bigint").alias("n_words"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without those that hold a window similar to an item."""
    bad = staged(matches(docs, benchmark, **how).select("doc_id", "text_hash").distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["text_hash"])
    return docs.join(bad, same, "left_anti")


def op9_simhash_windows(spark, folder):
    return matches(documents(spark, folder), table(spark, folder, "benchmark")).drop("text_hash")
