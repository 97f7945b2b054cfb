"""Quality rules by distribution divergence.

Each document gives two histograms: characters by class, and its common
function words against all other words.  The sums over all documents of a
language are that language's references; a document is rejected if the
Jensen-Shannon distance (base 2, 0 to 1) of one of its histograms to its
reference exceeds a limit.  The limit of the words is ``max_words`` plus
``word_noise`` over the root of the document's number of words, as the distance
of a clean text falls that way; both are fixed values, chosen on the 3,980 labelled
rows of sf0.1, and nothing is fitted at run time.  The guard: only documents of ``min_words`` words or
more are judged by the method, so a short text is never rejected for the noise
of its few words.

Nulls and edges: a NULL text is empty, a NULL language a language of its own;
a language without any counted character or word has distance 0; rows that
repeat are judged each; an empty table gives an empty result.  Of the input
only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import byte_rows, documents, lists, raw, staged

# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = (
    "the of and to in is was for on are as with at by from this that be have or not "
    "der die das und ist von zu den mit auf eine im dem nicht ein des "
    "le la les et est du un une dans que qui pour pas sur par avec au "
    "el los las de y en es por con para una se del como su lo a"
).split()
_WORDS = list(dict.fromkeys(w.encode() for w in COMMON_WORDS))

# Classes of characters, told from the first byte of their UTF-8 form.
CLASSES = ("lower", "upper", "digit", "blank", "line_break", "mark", "symbol", "other_ascii", "latin", "two_byte", "three_byte", "four_byte")
_REST = len(CLASSES)


def _class_table() -> np.ndarray:
    of = np.full(256, _REST, np.uint8)
    of[:128] = CLASSES.index("other_ascii")
    for name, chars in (("lower", bytes(range(97, 123))), ("upper", bytes(range(65, 91))), ("digit", b"0123456789"), ("blank", b" \t"),
                        ("line_break", b"\n\r\x0b\x0c"), ("mark", b".,;:!?'\"()-"), ("symbol", b"#*$%&|<>")):
        of[list(chars)] = CLASSES.index(name)
    for name, low, high in (("latin", 0xC2, 0xCB), ("two_byte", 0xCC, 0xDF), ("three_byte", 0xE0, 0xEF), ("four_byte", 0xF0, 0xF7)):
        of[low:high + 1] = CLASSES.index(name)
    return of


_CLASS = _class_table()
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS] + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("chars", "words")])


def repeated_words(words: list[bytes]) -> int:
    """Number of words that stand in a three-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    key = h[:-2] * _MIX[0] + h[1:-1] * _MIX[1] + h[2:] * _MIX[2]
    order = np.argsort(key)
    same = np.diff(key[order]) == 0
    if not same.any():
        return 0
    at = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    mark = np.zeros(n, bool)
    for k in range(3):
        mark[at + k] = True
    return int(mark.sum())


def text_stats(text: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The five counts, the character classes and the common words of one text."""
    words = text.split()  # splits bytes on 0x20 and 0x09-0x0D
    classes = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=_REST + 1)[:_REST]
    lines = [x for x in text.split(b"\n") if x.strip()]
    count = Counter(words)
    common = np.array([count.get(w, 0) for w in _WORDS] + [0], np.int64)
    common[-1] = len(words) - common.sum()
    blanks = classes[CLASSES.index("blank")] + classes[CLASSES.index("line_break")]
    counts = [len(words), int(classes.sum() - blanks), int(classes[CLASSES.index("symbol")]), len(lines) - len(set(lines)),
              repeated_words(words) if len(count) < len(words) else 0]
    return counts, classes, common


@F.arrow_udf(STATS)
def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = [text_stats(t) for t in byte_rows(batch)]
        n = len(rows)
        counts = np.array([r[0] for r in rows], np.int64).reshape(n, 5)
        columns = [pa.array(counts[:, k]) for k in range(5)]
        for k, width in ((1, _REST), (2, len(_WORDS) + 1)):
            columns.append(lists(np.concatenate([r[k] for r in rows]) if n else np.zeros(0, np.int64), [width] * n, pa.int64()))
        yield pa.StructArray.from_arrays(columns, [*_COUNTS, "chars", "words"])


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p to the same row of q; 0 where one has no mass."""
    sp, sq = p.sum(1, keepdims=True), q.sum(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / sp, q / sq
        m = (p + q) / 2
        part = lambda x: np.where(x > 0, x * np.log2(x / m), 0.0).sum(1)
        d = np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))
    return np.where((sp[:, 0] > 0) & (sq[:, 0] > 0), d, 0.0)


@F.arrow_udf(T.DoubleType())
def js_distance(histogram: pa.Array, reference: pa.Array) -> pa.Array:
    if not len(histogram):
        return pa.array([], pa.float64())
    shape = (len(histogram), -1)
    flat = lambda a: a.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(shape)
    return pa.array(_distance(flat(histogram), flat(reference)))


def _sums(column: str, width: int):
    return F.array(*[F.sum(F.element_at(column, k + 1)) for k in range(width)])


def references(stat: DataFrame, min_words: int = 50) -> DataFrame:
    """Per language the summed histograms of all its documents of ``min_words`` words or more.

    One row per language; sums are combined before the shuffle, so a language
    with most of the rows is no burden.  Where a language has only shorter
    documents its reference is empty, and so every distance 0.
    """
    counted = F.when(F.col("n_words") >= min_words, F.lit(1)).otherwise(F.lit(0))
    weigh = lambda c: F.transform(c, lambda x: x * counted)
    return (stat.select("lang", weigh(F.col("chars")).alias("chars"), weigh(F.col("words")).alias("words")).groupBy("lang")
            .agg(_sums("chars", _REST).alias("ref_chars"), _sums("words", len(_WORDS) + 1).alias("ref_words")))


def _verdict(d: DataFrame, min_words: int, max_chars: float, max_words: float, word_noise: float) -> DataFrame:
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    word_limit = max_words + word_noise / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    far = (F.col("n_words") >= min_words) & ((F.col("char_distance") > max_chars) | (F.col("word_distance") > word_limit))
    return d.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_words: int = 50,
          max_chars: float = 0.3, max_words: float = 0.18, word_noise: float = 1.0) -> DataFrame:
    """One row per document: its counts, both distances and whether the rules keep it.

    The counts and histograms are taken in one pass and staged; the references
    are joined to that narrow table, on which Spark splits a hot language.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), stats(raw(F.col(text_col))).alias("s"))
    stat = staged(d.select("doc_id", "lang", "s.*"), "quality")
    ref = references(stat, min_words).withColumnRenamed("lang", "ref_lang")
    both = stat.join(ref, F.col("lang").eqNullSafe(F.col("ref_lang")))
    far = both.withColumn("char_distance", js_distance("chars", "ref_chars")).withColumn("word_distance", js_distance("words", "ref_words"))
    return _verdict(far, min_words, max_chars, max_words, word_noise).select(
        "doc_id", *_COUNTS, "base_failed", "kept", "char_distance", "word_distance")


def accepted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_words: int = 50, max_chars: float = 0.3,
             max_words: float = 0.18, word_noise: float = 1.0) -> DataFrame:
    """The documents that :func:`judge` keeps, with all their columns.

    The counts are taken once and written beside the rows; the references (a row per
    language) are joined to that table, so no text moves and none is counted again.
    """
    names = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(lang_col).cast("string").alias("lang"), stats(raw(F.col(text_col))).alias("s"))
    d = staged(d.select("row", "lang", "s.*"), "quality-rows")
    ref = references(d, min_words).withColumnRenamed("lang", "ref_lang")
    d = d.join(ref, F.col("lang").eqNullSafe(F.col("ref_lang")))
    d = d.withColumn("char_distance", js_distance("chars", "ref_chars")).withColumn("word_distance", js_distance("words", "ref_words"))
    return _verdict(d, min_words, max_chars, max_words, word_noise).where("kept").select("row.*")


def op10_quality_divergence(spark, folder):
    return judge(documents(spark, folder))
