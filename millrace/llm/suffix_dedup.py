"""Removal of repeated byte strings with longest-previous-factor arrays.

Texts are UTF-8 bytes.  A byte goes if a string of ``length`` bytes that covers
it also starts elsewhere (``keep="none"``), or starts earlier, by identifier and
place (``keep="first"``), in the corpus as it was given.

Candidates come from :mod:`millrace.llm.repeats`, in pools.  In a pool the
windows are brought into suffix order; the previous and next smaller positions
of a window in that order are its nearest earlier neighbours, and its longest
previous factor is what it shares with one of them.  As only factors of
``length`` bytes count, the order is cut off there: windows compare by the hash
of their first ``length`` bytes, built by prefix doubling, so equal ones are
neighbours and the order of different ones is that of their hashes.

Nulls and edges: a NULL text is empty; texts shorter than ``length`` lose
nothing; equal rows (identifier and text) are one document and no repeat of each
other; an empty table gives an empty result; very long texts are read in
segments, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import byte_rows, documents
from millrace.llm.repeats import Shape, byte_hashes, merged, run_hashes, with_ranges


def previous_smaller(order: np.ndarray) -> np.ndarray:
    """For each place of an array, the nearest place before it with a smaller value, or -1."""
    at = np.arange(-1, len(order) - 1)
    while True:
        wrong = (at >= 0) & (order[at] > order)
        if not wrong.any():
            return at
        at[wrong] = at[at[wrong]]  # what lies between is larger still


def previous_factors(windows: np.ndarray) -> np.ndarray:
    """The earlier position that shares the whole window with each position, or -1.

    ``windows`` holds a hash per position.  The longest previous factor of a
    position is shared with its previous or its next smaller position in suffix
    order; one of ``length`` bytes or more exists if that window's hash is equal.
    """
    order = np.argsort(windows, kind="stable")
    before = previous_smaller(order)
    after = len(order) - 1 - previous_smaller(order[::-1])[::-1]
    hit = np.full(len(order), -1, np.int64)
    sorted_ = windows[order]
    for near in (before, after):
        ok = (near >= 0) & (near < len(order))
        ok[ok] = sorted_[near[ok]] == sorted_[ok]
        hit[order[ok]] = order[near[ok]]
    return hit


def runs(mark: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


def matcher(length: int, first_stays: bool):
    def match(cuts: list[bytes], anchor: np.ndarray) -> list[list[tuple[int, int]]]:
        """Windows of each surrounding that occur in another one, over the whole pool in document order."""
        hashes = run_hashes(byte_hashes(b"".join(cuts)), length)
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        starts, counts = np.cumsum(sizes) - sizes, sizes - length + 1
        ends = np.cumsum(counts)
        at = np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1])  # windows inside a surrounding
        earlier = previous_factors(hashes[at])
        mark = earlier >= 0
        if not first_stays:
            mark[earlier[mark]] = True  # what is somebody's earlier match has a later one
        return [runs(m) for m in np.split(mark, ends[:-1])]

    return match


KEPT = T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())])


@F.arrow_udf(KEPT)
def cut_out(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, ranges in batches:
        kept, removed, spans = [], [], []
        for t, r in zip(byte_rows(texts), ranges, strict=True):
            start, end = merged(r.values.to_numpy(zero_copy_only=False) if r.is_valid else np.zeros(0, np.int64))
            edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(t)]
            kept.append(b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            removed.append(int((end - start).sum()))
            spans.append(len(start))
        yield pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], KEPT.names)


def without_repeats(docs: DataFrame, length: int = 200, keep: str = "first", gram: int | None = None, **how) -> DataFrame:
    """(doc_id, bytes, kept, n_removed, n_spans) for every row; ``kept`` are the remaining bytes."""
    shape = Shape.of(length, False, gram)
    found = with_ranges(docs, shape, matcher(length, keep == "first"), keep == "first", **how)
    return found.select("doc_id", "bytes", cut_out("bytes", "ranges").alias("r")).select("doc_id", "bytes", "r.*")


def op2_suffix_dedup(spark, folder):
    d = without_repeats(documents(spark, folder), length=200, keep="none")
    return d.select("doc_id", F.length("bytes").cast("bigint").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
