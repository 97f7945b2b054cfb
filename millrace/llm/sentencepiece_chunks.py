"""SentencePiece encoding and decoding with a table of distinct chunks.

The library writes a text with a marker for each blank and one in front.  Where
no piece of the model holds a marker after another character, no merge ever
joins what stands on both sides of such a place, so a text is cut there and each
chunk (blanks, then the characters up to the next blank) is segmented by itself.
Every worker keeps a table of the distinct chunks it met with their ids: a chunk
goes through the library once, and the ids of a text are gathered from the table
by position.  The table is emptied at ``table_rows`` chunks or ``TABLE_BYTES``, which bounds memory
and changes no result.  It lives in the tasks, as a join of every word position
with one table for the whole corpus would move more bytes than the texts have.

A model whose pieces do cross markers, or that rewrites characters, is given the
whole texts; the ids are the library's in either case.

Nulls and edges: a NULL text is empty; an empty text has no ids and decodes to
an empty text; NULL ids decode to an empty text; repeated rows are encoded each;
an empty table gives an empty result.  Texts longer than a slice are handled by
themselves, whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import documents, lists

MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")
SLICE_CHARS, SLICE_IDS = 1 << 19, 1 << 17
#: About what a table may hold before it is emptied, whatever the length of its chunks.
TABLE_BYTES = 64 << 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=4)
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def separable(model: str) -> bool:
    """Whether the ids of a text are those of its chunks in a row."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    plain = norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
    bpe = proto.trainer_spec.model_type == proto.trainer_spec.BPE and not proto.trainer_spec.treat_whitespace_as_suffix
    user_defined = any(p.type == p.USER_DEFINED for p in proto.pieces)
    crossing = any(MARK in p.piece.lstrip(MARK) for p in proto.pieces)
    has_mark = any(p.piece == MARK for p in proto.pieces)
    return plain and bpe and has_mark and not user_defined and not crossing


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first marker; together they are the marked text."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")  # the library writes a blank as this character
    if text[0] != " " and "  " not in text:
        return text.split(" ")
    return [c[1:] for c in _CHUNK.findall(" " + text)]


class ChunkTable:
    """Distinct chunks and their ids, kept flat."""

    def __init__(self, model: str, table_rows: int):
        self.lib, self.limit = processor(model), table_rows
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.first, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used, self.held = np.zeros(4096, np.int32), 0, 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if len(a) >= n else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])

    def add(self, keys: list[str]) -> None:
        coded = self.lib.encode(keys, num_threads=1)
        marker = [self.lib.piece_to_id(MARK)]
        coded = [ids if key else marker for key, ids in zip(keys, coded, strict=True)]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        at, n = len(self.row), len(self.row) + len(keys)
        total = int(sizes.sum())
        self.first, self.size, self.ids = self._room(self.first, n), self._room(self.size, n), self._room(self.ids, self.used + total)
        self.size[at:n] = sizes
        self.first[at:n] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + total] = np.fromiter((i for ids in coded for i in ids), np.int32, total)
        self.used += total
        self.row.update(zip(keys, range(at, n), strict=True))
        self.held += 4 * sum(map(len, keys)) + 4 * total + 150 * len(keys)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        parts = [chunks(t) for t in texts]
        keys = [k for p in parts for k in p]
        if len(self.row) > self.limit or self.held > TABLE_BYTES:
            self.clear()
        new = [k for k in set(keys) if k not in self.row]
        if new:
            self.add(new)
        rows = np.fromiter(map(self.row.__getitem__, keys), np.int64, len(keys))
        sizes = self.size[rows]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.first[rows] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.cumsum([0] + [len(p) for p in parts])]
        return ids, np.diff(bounds)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum up to about ``most``; a larger row stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _sliced(known: ChunkTable, texts: list[str], by_chunk: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and their numbers, a slice of texts at a time."""
    for a, b in slices([len(t) for t in texts], SLICE_CHARS):
        if by_chunk:
            yield known.encode(texts[a:b])
        else:
            coded = known.lib.encode(texts[a:b], num_threads=1)
            yield np.array([i for x in coded for i in x], np.int32), np.array([len(x) for x in coded], np.int64)


def encode(text: Column, model: str | None = None, table_rows: int = 300_000) -> Column:
    """The ids of a text as the library gives them, without begin or end ids."""
    path = model or default_model()
    by_chunk = separable(path)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = ChunkTable(path, table_rows)
        for batch in batches:
            flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for got, n in _sliced(known, [t or "" for t in batch.to_pylist()], by_chunk):
                flat.append(got)
                sizes.append(n)
            yield lists(np.concatenate(flat), np.concatenate(sizes), pa.int32())

    return ids(F.coalesce(text, F.lit("")))


def coded(text: Column, model: str | None = None, table_rows: int = 300_000, with_ids: bool = True) -> Column:
    """struct<n_tokens, ids_sha256, decoded_sha256> of a text, and its ``ids`` if wanted.

    Encoding, decoding and the digests are one function, so a task has one worker
    with one model, and neither ids that nobody wants nor decoded texts leave it.
    """
    path = model or default_model()
    by_chunk = separable(path)
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
                        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    @F.arrow_udf(kind)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = ChunkTable(path, table_rows)
        spelled = [str(i) for i in range(known.lib.get_piece_size())]
        for batch in batches:
            sizes, digest, back, flat = [np.zeros(0, np.int64)], [], [], [np.zeros(0, np.int32)]
            for got, n in _sliced(known, [t or "" for t in batch.to_pylist()], by_chunk):
                sizes.append(n)
                if with_ids:
                    flat.append(got)
                ends, each = np.cumsum(n).tolist(), got.tolist()
                texts = [each[e - k:e] for e, k in zip(ends, n.tolist(), strict=True)]
                digest += [hashlib.sha256(",".join([spelled[i] for i in ids]).encode()).hexdigest() for ids in texts]
                for a, b in slices(n.tolist(), SLICE_IDS):
                    back += [hashlib.sha256(t.encode()).hexdigest() for t in known.lib.decode(texts[a:b], num_threads=1)]
            n = np.concatenate(sizes)
            columns = [pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())]
            columns += [lists(np.concatenate(flat), n, pa.int32())] if with_ids else []
            yield pa.StructArray.from_arrays(columns, [f.name for f in kind.fields])

    return pieces(F.coalesce(text, F.lit("")))


def decode(ids: Column, model: str | None = None) -> Column:
    """The text of a list of ids as the library's decode gives it."""
    path = model or default_model()

    @F.arrow_udf(T.StringType())
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lib = processor(path)
        for batch in batches:
            sizes = [n or 0 for n in batch.value_lengths().to_pylist()]
            out: list[str] = []
            for a, b in slices(sizes, SLICE_IDS):
                out += lib.decode([x or [] for x in batch.slice(a, b - a).to_pylist()], num_threads=1)
            yield pa.array(out, pa.string())

    return text(ids)


def op4_sentencepiece_chunks(spark, folder):
    return documents(spark, folder).select("doc_id", coded(F.col("text"), with_ids=False).alias("c")).select("doc_id", "c.*")
