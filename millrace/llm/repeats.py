"""Where a stretch of ``window`` tokens occurs twice in a corpus, found without comparing all stretches.

A hash is given to each run of ``gram`` tokens, and every window picks the least
of its runs, its anchor (winnowing).  Equal windows pick the same anchor, so
they meet under its hash; windows next to each other mostly share the anchor,
so a corpus has an anchor for every few dozen bytes or handful of words.  The
windows of one anchor form one stretch, its surrounding.

1. Anchors and the hash of their surrounding are dealt by anchor.  A surrounding
   that occurs again is decided there, whole.  Only the first of each kind goes
   on, and only if its anchor has other surroundings too.
2. Those surroundings are cut from the texts and pooled by anchor; the operator
   that uses this module matches the windows of a pool by its own method.
3. An anchor with more than ``hot`` different surroundings is not pooled:
   hashes of its windows are aggregated, which needs no group in one place.
4. The ranges found are joined to the texts.

Documents are ordered by identifier; rows of one identifier by a hash of the
text, taken only where identifiers repeat.  Equal rows are one document.  Rows
without identifier come last.  Equality is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm.common import byte_rows, mixed, raw, staged

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SEGMENT = 1 << 19  # windows of a very long text that are looked at together
POOL_BYTES = 1 << 20
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _B)


def byte_hashes(text: bytes) -> np.ndarray:
    return _BYTE[np.frombuffer(text, np.uint8)]


def word_hashes(text: bytes) -> np.ndarray:
    words = text.split()  # bytes: splits on 0x20 and 0x09-0x0D
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A + b
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def run_hashes(h: np.ndarray, length: int, known: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Hashes of all runs of ``length`` tokens by doubling; two overlapping halves make a length that is no power of two."""
    if len(h) < length:
        return np.zeros(0, np.uint64)
    size = 1
    known = {1: h} if known is None else known
    while size * 2 <= length:
        if size * 2 not in known:
            known[size * 2] = _joined(known[size][:-size], known[size][size:])
        size *= 2
    x = known[size]
    return x if size == length else _joined(x[:len(h) - length + 1], x[length - size:])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row, by running minima of blocks from both sides."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


@dataclass(frozen=True)
class Shape:
    window: int
    gram: int
    words: bool

    @classmethod
    def of(cls, window: int, words: bool, gram: int | None = None) -> Shape:
        """Runs of a quarter of the window by default; a surrounding has at most 256 windows."""
        return cls(window, max(gram or window // 4, 1, window - 255), words)

    def hashes(self, text: bytes) -> np.ndarray:
        return word_hashes(text) if self.words else byte_hashes(text)

    def anchors(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per anchor: its hash, that of its surrounding, and the first and last window it stands for."""
        parts = []
        for start in range(0, max(0, len(tokens) - self.window + 1), SEGMENT):
            h = tokens[start:start + SEGMENT + self.window - 1]
            known = {1: h}
            gram, whole = run_hashes(h, self.gram, known), run_hashes(h, self.window, known)
            key = (gram >> np.uint64(32) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)
            pick = (sliding_least(key, self.window - self.gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            change = np.flatnonzero(np.diff(pick)) + 1
            low, high = np.concatenate([[0], change]), np.concatenate([change - 1, [len(pick) - 1]])
            around = _joined(_joined(whole[low], whole[high]), (high - low).astype(np.uint64))
            parts.append((gram[pick[low]], around, low + start, high + start))
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def cut(self, text: bytes, lows, highs) -> list[bytes]:
        """The surroundings of a text as bytes, words joined by a blank."""
        if self.words:
            words = text.split()
            return [b" ".join(words[a:b + self.window]) for a, b in zip(lows, highs, strict=True)]
        return [text[a:b + self.window] for a, b in zip(lows, highs, strict=True)]


_STEP = 256  # a range of windows as one number: first * 256 + (last - first)
_ANCHOR = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("c", T.LongType()), T.StructField("span", T.LongType())]))


def _anchor_rows(shape: Shape):
    @F.arrow_udf(_ANCHOR)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [shape.anchors(shape.hashes(t)) for t in byte_rows(batch)]
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(f[0]) for f in found], out=offsets[1:])
            h, c, low, high = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(4))
            rows = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(low * _STEP + (high - low))], ["h", "c", "span"])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return of


def _cut_rows(shape: Shape):
    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            out = []
            for t, s in zip(byte_rows(texts), spans, strict=True):
                v = s.values.to_numpy(zero_copy_only=False)
                out.append(shape.cut(t, (v // _STEP).tolist(), (v // _STEP + v % _STEP).tolist()))
            yield pa.array(out, pa.list_(pa.binary()))

    return of


def _window_hashes(shape: Shape):
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([run_hashes(shape.hashes(t), shape.window).view(np.int64) for t in byte_rows(batch)], pa.list_(pa.int64()))

    return of


#: A pool of surroundings: their bytes, and the number of each one's anchor; in document order within an anchor.
#: The answer holds, for each surrounding, its windows that occur elsewhere (or earlier), as first and last.
Match = Callable[[list[bytes], np.ndarray], list[list[tuple[int, int]]]]
_FOUND = T.StructType([T.StructField("id", T.LongType()), T.StructField("th", T.LongType()), T.StructField("range", T.LongType())])
_LONG = 1 << 16  # a range of tokens as one number: first * 65536 + length


def _pool_matches(shape: Shape, match: Match):
    def pools(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Whole anchors together, until a pool is large enough."""
        rows: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "id", "th", "span", "cut")), strict=True):
                if last is not None and row[:4] == last[:4]:
                    continue  # the same row of a document again
                if last is not None and row[0] != last[0] and size > POOL_BYTES:
                    yield rows
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
                last = row
        if rows:
            yield rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in pools(batches):
            anchor = np.cumsum([0] + [a[0] != b[0] for a, b in zip(rows, rows[1:], strict=False)])
            out = [], [], []
            for (_, doc, th, span, _), found in zip(rows, match([r[4] for r in rows], anchor), strict=True):
                for first, final in found:
                    out[0].append(doc)
                    out[1].append(th)
                    out[2].append((span // _STEP + first) * _LONG + final - first + shape.window)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=_FOUND.names)

    return run


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row columns..., id, th, bytes): a null identifier counts as the largest."""
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(2 ** 63 - 1))
    base = docs.select(key.alias("id"), F.col(id_col).alias("doc_id"), raw(F.col(text_col)).alias("bytes"))
    repeated = not base.groupBy("id").count().where("count > 1").isEmpty()
    th = F.xxhash64("bytes") if repeated else F.lit(0).cast("bigint")
    return base.select("id", "doc_id", th.alias("th"), "bytes")


def ranges(base: DataFrame, shape: Shape, match: Match, first_stays: bool, hot: int) -> DataFrame:
    """(id, th, range): token ranges covered by windows that also start elsewhere, or earlier where the first stays."""
    rows = base.select("id", "th", F.inline(_anchor_rows(shape)("bytes")))
    here = F.struct("id", "th", "span")
    same = Window.partitionBy("h", "c")
    seen = rows.withColumn("low", F.min(here).over(same)).withColumn("high", F.max(here).over(same))
    first = F.col("low") == here
    seen = seen.withColumn("kinds", F.sum(first.cast("int")).over(Window.partitionBy("h")))
    decided = ~first if first_stays else F.col("low") != F.col("high")
    pooled = first & (F.col("kinds") > 1)
    seen = seen.select("h", "id", "th", "span", decided.alias("decided"), pooled.alias("pooled"), (F.col("kinds") > hot).alias("hot"))
    seen = staged(seen.where("decided or pooled"), "anchors")

    start = F.shiftright("span", 8)
    whole = seen.where("decided").select("id", "th", (start * _LONG + F.col("span").bitwiseAND(F.lit(_STEP - 1)) + shape.window).alias("range"))

    wanted = seen.where("pooled").groupBy("id", "th").agg(F.collect_list(F.struct("h", "span", "hot")).alias("r"))
    cut = base.select("id", "th", "bytes").join(wanted, ["id", "th"]).withColumn("cuts", _cut_rows(shape)("bytes", F.col("r.span")))
    cut = cut.select("id", "th", F.inline(F.arrays_zip("r", "cuts"))).select("id", "th", "r.*", F.col("cuts").alias("cut"))
    cut = staged(cut, "surroundings")

    pool = cut.where("not hot").select("h", "id", "th", "span", "cut").repartition("h").sortWithinPartitions("h", "id", "th", "span")
    matched = pool.mapInArrow(_pool_matches(shape, match), _FOUND)

    each = cut.where("hot").select("id", "th", start.alias("start"), F.posexplode(_window_hashes(shape)("cut")).alias("k", "w"))
    each = each.select("w", "id", "th", (F.col("start") + F.col("k")).alias("start"))
    place = F.struct("id", "th", "start")
    twice = each.groupBy("w").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("w", "low")
    crowd = each.join(twice, "w")
    if first_stays:
        crowd = crowd.where(F.col("low") != place)
    crowd = crowd.select("id", "th", (F.col("start") * _LONG + shape.window).alias("range"))
    return whole.union(matched).union(crowd)


def with_ranges(docs: DataFrame, shape: Shape, match: Match, first_stays: bool, hot: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, bytes, ranges) for every row; ``ranges`` is NULL where nothing repeats."""
    base = _identified(docs, id_col, text_col)
    found = ranges(base, shape, match, first_stays, hot).groupBy("id", "th").agg(F.collect_list("range").alias("ranges"))
    return base.join(found, ["id", "th"], "left").select("doc_id", "bytes", "ranges")


def merged(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint sorted ranges [start, end) of range numbers; touching ones are joined."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values = np.unique(values)
    start, end = values // _LONG, np.maximum.accumulate(values // _LONG + values % _LONG)
    fresh = np.concatenate([[True], start[1:] > end[:-1]])
    return start[fresh], np.concatenate([end[:-1][fresh[1:]], end[-1:]])
