"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Two lexicons are learned from labelled documents: words, and beginnings of words
(for languages that inflect or compound).  An entry needs a document frequency
and an odds ratio.  A text then gives densities of both lexicons, hits near a
second-person pronoun, capitals, punctuation, exclamation and obfuscation rates.
Trees are boosted on these and their output is calibrated to a probability.

Learning reads at most ``max_train`` labelled documents, chosen by a hash of the
identifier.  Lexicon entries of one half give the features of the other, and the
calibration sees only scores of trees that didn't see the document.  Texts stay
on the executors: the driver gets counts of at most ``max_lexicon`` candidates
and a row of numbers per training document.

Nulls and edges: a NULL text is empty, an empty text has a score too; a document
without label isn't learned from, several labels of one identifier count as
toxic if one does; without any labelled row every score is 0; repeated rows are
scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.boosted_trees import Boosted, boost, isotonic
from millrace.llm.common import documents, staged, table

# Pronouns and possessives of the second person in English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner euch euer tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split())
# Signs that stand for letters in disguised words.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

_EDGE = ".,;:!?\"'()[]{}<>|*#%&-_…«»¡¿"
_HIDDEN = re.compile(r"[^\W\d_][0-9@$!*]+[^\W\d_]")
_DROPPED = re.compile(r"[*._\-]")
PREFIXES = (4, 5)
NEAR = 4
LEXICON, PREFIX, YOU, HIDDEN = 1, 2, 4, 8
FEATURES = ("word_density", "prefix_density", "any_density", "hits", "near_you", "you_density", "capitals", "all_caps", "marks", "exclamations", "hidden", "log_words")


def normal(word: str) -> str:
    """A word in lower case without signs at its ends, disguised letters undone."""
    w = word.strip(_EDGE).lower()
    return _DROPPED.sub("", w).translate(LOOKALIKE) if _HIDDEN.search(w) else w


@dataclass
class Lexicon:
    words: frozenset[str]
    prefixes: frozenset[str]

    def flags(self, word: str) -> int:
        w = normal(word)
        return ((w in self.words) * LEXICON + any(w[:k] in self.prefixes for k in PREFIXES if len(w) >= k) * PREFIX
                + (w in SECOND_PERSON) * YOU + bool(_HIDDEN.search(word)) * HIDDEN)


class Reader:
    """Feature rows of texts; remembers the flags of words, emptied at ``most`` words."""

    def __init__(self, lexicon: Lexicon, most: int = 300_000):
        self.lexicon, self.most, self.known = lexicon, most, {}

    def row(self, text: str) -> list[float]:
        words = text.split()
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = self.lexicon.flags(w)
        n = len(words)
        f = np.fromiter(map(known.__getitem__, words), np.int64, n)
        hit, you = np.flatnonzero(f & (LEXICON | PREFIX)), np.flatnonzero(f & YOU)
        near = 0
        if len(hit) and len(you):
            at = np.searchsorted(you, hit)
            near = int((np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hit), np.abs(you[np.maximum(at - 1, 0)] - hit)) <= NEAR).sum())
        b = np.bincount(np.frombuffer(text.encode(errors="replace"), np.uint8), minlength=256)
        chars, some = max(1, len(text)), max(1, n)
        marks = int(b[33:48].sum() + b[58:65].sum() + b[91:97].sum() + b[123:127].sum())
        caps = sum(w.isupper() and len(w) > 2 for w in words) if b[65:91].sum() > 0.2 * chars else 0
        return [int((f & LEXICON > 0).sum()) / some, int((f & PREFIX > 0).sum()) / some, len(hit) / some, float(min(len(hit), 50)), near / some, len(you) / some,
                int(b[65:91].sum()) / chars, caps / some, marks / chars, int(b[33]) / chars, int((f & HIDDEN > 0).sum()) / some, float(np.log1p(n))]

    def rows(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.row(t or "") for t in texts], float).reshape(-1, len(FEATURES))


@dataclass
class Model:
    lexicon: Lexicon
    trees: Boosted | None
    at: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.raw(x), self.at, self.value) if self.trees else np.zeros(len(x))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """(text, toxic, half) of at most ``max_train`` labelled documents outside the held-out part."""
    of = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    of = of.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = of.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_train rows
    return staged(found.select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).cast("int").alias("half")), "toxicity-training")


def candidate_counts(rows: DataFrame, least: int, max_lexicon: int) -> list:
    """Document frequencies of words and beginnings in each half, toxic and not, most telling first."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for t in batch.to_pylist():
                words = {normal(w) for w in set((t or "").split())} - {""}
                out.append(sorted({f"w{w}" for w in words} | {f"p{w[:k]}" for w in words for k in PREFIXES if len(w) >= k}))
            yield pa.array(out, pa.list_(pa.string()))

    count = lambda toxic, half: F.sum(((F.col("toxic") == toxic) & (F.col("half") == half)).cast("int"))
    found = rows.withColumn("token", F.explode(tokens("text"))).groupBy("token")
    found = found.agg(*[count(t, h).alias(f"{'tc'[1 - t]}{h}") for t in (1, 0) for h in (0, 1)]).where(F.col("t0") + F.col("t1") >= least)
    excess = (F.col("t0") + F.col("t1")) / (F.col("c0") + F.col("c1") + 1)
    return found.orderBy(excess.desc(), "token").limit(max_lexicon).collect()


def choose(counts: list, totals: dict[tuple[int, int], int], halves: tuple[int, ...], least: int, odds: float) -> Lexicon:
    n = {t: sum(totals.get((t, h), 0) for h in halves) for t in (1, 0)}
    words, prefixes = set(), set()
    for r in counts:
        t, c = sum(r[f"t{h}"] for h in halves), sum(r[f"c{h}"] for h in halves)
        if t >= least and ((t + 0.5) / (n[1] + 1)) / ((c + 0.5) / (n[0] + 1)) >= odds:
            (words if r["token"][0] == "w" else prefixes).add(r["token"][1:])
    return Lexicon(frozenset(words), frozenset(prefixes))


def features(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels of bounded training rows, on the driver."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(lexicon)
        for batch in batches:
            yield pa.array(reader.rows(batch.to_pylist()).tolist(), pa.list_(pa.float64()))

    got = rows.select(of("text").alias("x"), "toxic").collect()
    return np.array([r["x"] for r in got], float).reshape(-1, len(FEATURES)), np.array([r["toxic"] for r in got], float)


def train(docs: DataFrame, labels: DataFrame, max_train: int = 12_000, max_lexicon: int = 20_000, least: int = 3, odds: float = 12.0) -> Model:
    rows = training_rows(docs, labels, max_train)
    totals = {(r["toxic"], r["half"]): r["count"] for r in rows.groupBy("toxic", "half").count().collect()}
    if not totals:
        return Model(Lexicon(frozenset(), frozenset()), None, np.zeros(1), np.zeros(1))
    counts = candidate_counts(rows, least, max_lexicon)
    part = {}
    for half in (0, 1):  # features of one half by the lexicon of the other
        part[half] = features(rows.where(F.col("half") == half), choose(counts, totals, (1 - half,), least, odds))
    scores = [boost(*part[1 - half]).raw(part[half][0]) for half in (0, 1)]
    x, y = (np.concatenate([part[h][k] for h in (0, 1)]) for k in (0, 1))
    at, value = isotonic(np.concatenate(scores), y)
    return Model(choose(counts, totals, (0, 1), least, odds), boost(x, y), at, value)


def toxicity(text: Column, model: Model) -> Column:
    """The calibrated probability that a text is toxic."""

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(model.lexicon)
        for batch in batches:
            yield pa.array(model.score(reader.rows(batch.to_pylist())), pa.float64())

    return score(text)


def op6_toxicity_trees(spark, folder):
    docs = documents(spark, folder)
    model = train(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
