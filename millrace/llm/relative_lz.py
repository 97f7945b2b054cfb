"""Removal of repeated word runs by relative Lempel-Ziv parsing.

A word goes if a window of ``length`` consecutive words that covers it also
starts earlier: in a document of a smaller identifier, or before it in its own.

Candidates come from :mod:`millrace.llm.repeats`, in pools by anchor and in
document order.  The blocks seen so far are the reference, indexed by their
windows.  The next block is parsed greedily: at a place whose window is indexed,
the factor runs on as long as the reference goes on alike, and all of it is a
duplicate span.  A factor ends where the copied block ends or differs; parsing
goes on at the next window, which still overlaps the factor, so windows across
factor boundaries are looked up too.  Then the block joins the reference.

Nulls and edges: a NULL text has no words; documents of fewer words than
``length`` lose nothing; equal rows (identifier and text) are one document; a
row without identifier comes last; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import byte_rows, documents
from millrace.llm.repeats import Shape, merged, run_hashes, with_ranges, word_hashes


def factors(block: list[int], index: dict[int, tuple[list[int], int]]) -> list[tuple[int, int]]:
    """Greedy factors of a block, each as its first and last window; windows stand for their hashes."""
    found, at = [], 0
    while at < len(block):
        source = index.get(block[at])
        if source is None:
            at += 1
            continue
        other, place = source
        last = at
        while last + 1 < len(block) and place + 1 < len(other) and block[last + 1] == other[place + 1]:
            last, place = last + 1, place + 1
        found.append((at, last))
        at = last + 1
    return found


def matcher(length: int):
    def match(cuts: list[bytes], anchor: np.ndarray) -> list[list[tuple[int, int]]]:
        words = word_hashes(b" ".join(cuts))
        hashes = run_hashes(words, length)
        sizes = [c.count(b" ") + 1 for c in cuts]
        out, index, group, start = [], {}, None, 0
        for size, g in zip(sizes, anchor.tolist(), strict=True):
            if g != group:
                index, group = {}, g
            block = hashes[start:start + size - length + 1].tolist()
            start += size
            out.append(factors(block, index))
            for place, h in enumerate(block):
                index.setdefault(h, (block, place))
        return out

    return match


KEPT = T.StructType([T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])


@F.arrow_udf(KEPT)
def cut_out(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, ranges in batches:
        kept, total, removed = [], [], []
        for t, r in zip(byte_rows(texts), ranges, strict=True):
            words = t.split()
            start, end = merged(r.values.to_numpy(zero_copy_only=False) if r.is_valid else np.zeros(0, np.int64))
            edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(words)]
            kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]))
            total.append(len(words))
            removed.append(int((end - start).sum()))
        yield pa.StructArray.from_arrays([pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())], KEPT.names)


def without_copies(docs: DataFrame, length: int = 20, gram: int | None = None, **how) -> DataFrame:
    """(doc_id, kept, n_words, n_removed) for every row; ``kept`` are the remaining words, a blank between."""
    shape = Shape.of(length, True, gram)
    found = with_ranges(docs, shape, matcher(length), True, **how)
    return found.select("doc_id", cut_out("bytes", "ranges").alias("r")).select("doc_id", "r.*")


def op3_relative_lz(spark, folder):
    d = without_copies(documents(spark, folder), length=20)
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
