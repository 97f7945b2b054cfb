"""Scores of documents by the masked pseudo-likelihood of a bidirectional window network.

Words are counted over the whole corpus in a table that grows with it.  The
commonest, at most ``HEAD``, are tokens of their own; the others share ``TAIL`` tokens by
hash, and each has the share of its token that the table gives it, joined by
word; a word that the table lacks has the share of one mention.  Tokens fall into
``GROUPS * PER`` classes by frequency: the commonest have a class of
their own, the others share classes of about equal mass.  The network predicts
the class of each token, left out, from the ``REACH`` tokens on both sides, as the
group of the class and then the class in its group; the
token's share of its class is its corpus frequency.  As surroundings the
``OWN_INPUTS`` commonest words stand for themselves, the others for one of the
rest of ``INPUTS`` by hash.  A document's score is the
sum of the log-probabilities of its tokens.

Texts are cut and looked up once; training and scoring read the tokens, written
in two bytes each.  Training is numpy in the tasks: in each round every task runs gradient steps
over its part of the corpus, starting from the same weights, and the weights are
averaged over tasks by the number of positions, as sums that Spark combines.
Every position of every document is trained once: round ``k`` of ``ROUNDS`` takes
the positions that leave ``k``.  Documents are dealt to parts and put in order by the
hash of id and text, and the number of parts follows from the number of tokens, so
scores don't depend on files, cluster or reruns (but for the last bits of sums).
Weights, classes and the head have bounded sizes, so
the driver and the tasks hold the same few megabytes at any scale; the word table
stays in Spark.

Nulls and edges: a NULL or empty text has no tokens, score 0 and no mean; a
single word is scored from empty surroundings; repeated rows are scored each; an
empty table gives an empty result; a very long text is one row of its task, scored
in blocks of ``SCORED`` positions; words of one count are in the head by lots of a
hash or not at all, never by the order of rows; further columns, whatever their
names, are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import byte_rows, documents, raw, staged

GROUPS, PER = 8, 16
TOKENS, INPUTS, CLASSES, OWN = 1 << 16, 1 << 12, GROUPS * PER, 64
TAIL, OWN_INPUTS = 1 << 12, 3 << 10
HEAD = TOKENS - TAIL
LONGEST = 256  # bytes of a word of the head, which every task holds
_COUNTED = 100_000  # distinct words after which a task gives its counts away
WIDTH, REACH, ROUNDS, BATCH, SCORED = 16, 2, 2, 2048, 16384
PART, PARTS = 1 << 21, 1 << 16  # tokens that a task trains on, and the most tasks
_LEVELS, _LOTS = 32, 64  # levels of a count per power of two, and lots of the words of a level
PLACES = [k for k in range(-REACH, REACH + 1) if k]
_SIZES = {"embed": (INPUTS + 1, WIDTH), "place": (len(PLACES), WIDTH), "bias": (WIDTH,), "group": (WIDTH, GROUPS), "group_bias": (GROUPS,),
          "out": (GROUPS, WIDTH, PER), "out_bias": (GROUPS, PER)}
_LENGTH = sum(int(np.prod(s)) for s in _SIZES.values())
_CHUNK = 4096  # weights in one row when they are averaged
_CELLS = np.arange((INPUTS + 1) * WIDTH).reshape(INPUTS + 1, WIDTH)  # where each weight of "embed" lies


def tail_token(word: bytes) -> int:
    return HEAD + zlib.crc32(word) % TAIL


class Head(dict):
    """The token of each word of the head; another word has one of the tail."""

    def __missing__(self, word: bytes) -> int:
        return tail_token(word)


def tokens(words: list[bytes], head: Head) -> np.ndarray:
    return np.fromiter(map(head.__getitem__, words), np.int32, len(words))


@dataclass
class Weights:
    embed: np.ndarray
    place: np.ndarray
    bias: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def of(cls, flat: np.ndarray) -> Weights:
        parts, at = [], 0
        for shape in _SIZES.values():
            n = int(np.prod(shape))
            parts.append(flat[at:at + n].reshape(shape).astype(np.float32))
            at += n
        return cls(*parts)

    @classmethod
    def start(cls, mass: np.ndarray) -> Weights:
        """Small random weights; the output biases are the logs of the classes' mass."""
        random = np.random.default_rng(11)
        w = cls.of(random.normal(0, 0.1, _LENGTH))
        w.place += 1
        w.bias[:] = 0
        w.out_bias[:] = np.log(mass).reshape(GROUPS, PER)
        w.group_bias[:] = np.log(mass.reshape(GROUPS, PER).sum(axis=1))
        return w

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in _SIZES]).astype(np.float64)


def laid_out(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts behind each other with empty tokens between: the input tokens, where each token of ``ids`` stands, and its place in its text."""
    inputs = np.where(ids < OWN_INPUTS, ids, OWN_INPUTS + ids % (INPUTS - OWN_INPUTS))
    text = np.repeat(np.arange(len(lengths)), lengths)
    every = np.arange(len(ids))
    where = every + REACH * (text + 1)
    row = np.full(len(ids) + REACH * (len(lengths) + 1), INPUTS, np.int64)
    row[where] = inputs
    return row, where, every - (np.cumsum(lengths) - lengths)[text]


def surroundings(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The input tokens around each place of a laid out row."""
    return row[at[:, None] + PLACES]


def hidden(w: Weights, seen: np.ndarray) -> np.ndarray:
    x = np.einsum("npw,pw->nw", seen, w.place)
    x += w.bias
    return np.tanh(x, out=x)


def seen_from(w: Weights, around: np.ndarray) -> np.ndarray:
    return np.take(w.embed, around.ravel(), axis=0).reshape(len(around), len(PLACES), WIDTH)


def by_group(goal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts classes of a group together, and where each group starts and ends there."""
    group = (goal // PER).astype(np.int16)
    order = np.argsort(group, kind="stable")
    return order, np.searchsorted(group[order], np.arange(GROUPS + 1))


def log_softmax_at(score: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """The log-softmax of each column of the scores at its goal; one row per class, as sums over rows are fast."""
    score -= score.max(axis=0)
    picked = score[goal, np.arange(len(goal))]
    return picked - np.log(np.exp(score, out=score).sum(axis=0))


def log_probabilities(w: Weights, around: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Log-probability of the class of each token left out: of its group, and of the class in the group."""
    order, ends = by_group(goal)
    goal = goal[order]
    h = np.ascontiguousarray(hidden(w, seen_from(w, around[order])).T)
    value = log_softmax_at(w.group.T @ h + w.group_bias[:, None], goal // PER)
    for g in np.flatnonzero(np.diff(ends)):
        a, b = ends[g], ends[g + 1]
        value[a:b] += log_softmax_at(w.out[g].T @ h[:, a:b] + w.out_bias[g][:, None], goal[a:b] % PER)
    out = np.empty_like(value)
    out[order] = value
    return out


def slope(score: np.ndarray, goal: np.ndarray, each: np.float32) -> np.ndarray:
    """The gradient of the negative log-probabilities of each column's goal by the scores, in place."""
    score -= score.max(axis=0)
    np.exp(score, out=score)
    score *= each / score.sum(axis=0)
    score[goal, np.arange(len(goal))] -= each
    return score


def step(w: Weights, around: np.ndarray, goal: np.ndarray, rate: float) -> None:
    """One gradient step on the mean negative log-probability of a batch."""
    order, ends = by_group(goal)
    around, goal, each = around[order], goal[order], np.float32(rate / len(goal))
    seen = seen_from(w, around)
    h = np.ascontiguousarray(hidden(w, seen).T)
    p = slope(w.group.T @ h + w.group_bias[:, None], goal // PER, each)
    inner = w.group @ p
    w.group -= h @ p.T
    w.group_bias -= p.sum(axis=1)
    for g in np.flatnonzero(np.diff(ends)):
        a, b = ends[g], ends[g + 1]
        q = slope(w.out[g].T @ h[:, a:b] + w.out_bias[g][:, None], goal[a:b] % PER, each)
        inner[:, a:b] += w.out[g] @ q
        w.out[g] -= h[:, a:b] @ q.T
        w.out_bias[g] -= q.sum(axis=1)
    inner *= 1 - h * h
    w.bias -= inner.sum(axis=1)
    inner = np.ascontiguousarray(inner.T)
    move = inner[:, None, :] * w.place
    w.place -= np.einsum("npw,nw->pw", seen, inner)
    np.subtract.at(w.embed.reshape(-1), np.take(_CELLS, around.ravel(), axis=0).ravel(), move.ravel())  # .at is fast on one axis


@dataclass
class Words:
    """The token of each word of the head, the log-share of one mention in each token of the tail, and the table (word, n) of all words."""

    head: Head
    one: np.ndarray
    table: DataFrame


@dataclass
class Classes:
    """The class of each token, and the log of its share of the class."""

    of: np.ndarray
    share: np.ndarray
    mass: np.ndarray
    words: Words | None = None

    @classmethod
    def by_frequency(cls, counts: np.ndarray) -> Classes:
        counts = counts + 1.0  # a token not seen has a share too
        order = np.argsort(-counts, kind="stable")
        of = np.empty(TOKENS, np.int64)
        of[order[:OWN]] = np.arange(OWN)
        rest = np.cumsum(counts[order[OWN:]])
        of[order[OWN:]] = OWN + np.minimum((rest / rest[-1] * (CLASSES - OWN)).astype(np.int64), CLASSES - OWN - 1)
        mass = np.maximum(np.bincount(of, counts, CLASSES), 1e-9)
        return cls(of, np.log(counts / mass[of]), mass / mass.sum())


def word_table(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, token, n) of each distinct word of all documents; token is the one it has in the tail."""
    kind = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("token", T.IntegerType()), T.StructField("n", T.LongType())])

    def given(count: Counter) -> pa.RecordBatch:
        words = list(count)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([tail_token(w) for w in words], pa.int32()), pa.array(list(count.values()), pa.int64())], names=kind.names)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in batches:
            for t in byte_rows(batch.column(0)):
                count.update(t.split())  # bytes: splits on 0x20 and 0x09-0x0D
                if len(count) > _COUNTED:
                    yield given(count)
                    count = Counter()
        if count:
            yield given(count)

    each = docs.select(raw(F.col(text_col)).alias("bytes")).mapInArrow(counted, kind)
    return staged(each.groupBy("word", "token").agg(F.sum("n").alias("n")), "words")


def head_of(table: DataFrame) -> tuple[Head, np.ndarray]:
    """The commonest words, at most ``HEAD``, and their counts, by levels of the count and lots of a hash within them; only sums and the head itself reach the driver."""
    power = F.greatest(F.floor(F.log2("n")) - int(np.log2(_LEVELS)), F.lit(0)).cast("int")
    level = F.expr("shiftleft(shiftright(n, power), power)")
    ranked = (table.where(F.length("word") <= LONGEST).withColumn("power", power)
              .select("word", "n", level.alias("level"), F.pmod(F.xxhash64("word"), F.lit(_LOTS)).cast("int").alias("lot")))
    lots = ranked.groupBy("level", "lot").agg(F.count("*").alias("words")).toPandas().sort_values(["level", "lot"], ascending=False)
    taken = lots[lots["words"].cumsum() <= HEAD]
    if taken.empty:
        return Head(), np.zeros(0)
    last = taken.iloc[-1]
    top = ranked.where((F.col("level") > int(last["level"])) | (F.col("level") == int(last["level"])) & (F.col("lot") >= int(last["lot"])))
    top = top.select("word", "n").toPandas().sort_values(["n", "word"], ascending=[False, True])
    return Head((bytes(w), i) for i, w in enumerate(top["word"])), top["n"].to_numpy(float)


def vocabulary(docs: DataFrame, text_col: str) -> Classes:
    """The words of the corpus and the classes of their tokens; the driver gets the head and a row for each token of the tail."""
    table = word_table(docs, text_col)
    head, known = head_of(table)
    counts = np.zeros(TOKENS)
    counts[:len(known)] = known
    sums = table.groupBy("token").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toPandas()  # at most TAIL rows
    size = np.zeros((TOKENS, 2))
    size[sums["token"].to_numpy(np.int64)] = sums[["n", "words"]].to_numpy(float)
    for w, i in head.items():
        size[tail_token(w)] -= (known[i], 1)
    counts[HEAD:] = size[HEAD:, 0]
    classes = Classes.by_frequency(counts)
    classes.words = Words(head, -np.log(size[HEAD:].sum(axis=1) + 1), table.select("word", "n"))  # each word counts once more, and so does one not seen
    return classes


CODES = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("rare", T.ArrayType(T.BinaryType())), T.StructField("text_hash", T.LongType())])


def codes(text: Column, words: Words) -> Column:
    """The tokens of a text, two bytes each, its words of the tail, and a hash of the text."""
    head = words.head

    @F.arrow_udf(CODES)
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids, rare, hashes = [], [], []
            for t in byte_rows(batch):
                found = t.split()  # bytes: splits on 0x20 and 0x09-0x0D
                each = tokens(found, head)
                ids.append(each.astype("<u2").tobytes())
                rare.append([found[i] for i in np.flatnonzero(each >= HEAD).tolist()])
                hashes.append(xxhash.xxh3_64_intdigest(t))
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(rare, pa.list_(pa.binary())),
                                              pa.array(np.array(hashes, np.uint64).view(np.int64))], CODES.names)

    return code(raw(text))


def coded(docs: DataFrame, words: Words, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, ids, rare, n_tokens, place), written once; ``place`` orders documents for training."""
    each = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), codes(F.col(text_col), words).alias("c")).select("row", "doc_id", "c.*")
    return staged(each.select("row", "doc_id", "ids", "rare", F.floor(F.octet_length("ids") / 2).alias("n_tokens"), F.xxhash64("doc_id", "text_hash").alias("place")), "codes")


def token_rows(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a batch of texts, one behind the other, and the number of tokens of each."""
    each = byte_rows(a)
    return np.frombuffer(b"".join(each), "<u2").astype(np.int32), np.array([len(x) // 2 for x in each], np.int64)


def parts_for(n_tokens: int) -> int:
    return min(max(-(-n_tokens // PART), 1), PARTS)


def trained_round(rows: DataFrame, parts: int, classes: Classes, flat: np.ndarray, rate: float, k: int, rounds: int) -> np.ndarray:
    """The mean of the weights to which the tasks come in round ``k``, each weighed by its positions; all rounds together take each position once."""
    kind = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("positions", T.LongType()), T.StructField("weights", T.ArrayType(T.DoubleType()))])

    of = classes.of

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, n = Weights.of(flat), 0
        around, goal = np.empty((0, len(PLACES)), np.int64), np.empty(0, np.int64)
        for batch in batches:
            ids, lengths = token_rows(batch.column(0))
            row, where, inside = laid_out(ids, lengths)
            mine = np.flatnonzero(inside % rounds == k)
            for i in range(0, len(mine), 16 * BATCH):
                at = mine[i:i + 16 * BATCH]
                around, goal = np.concatenate([around, surroundings(row, where[at])]), np.concatenate([goal, of[ids[at]]])
                done = len(goal) // BATCH * BATCH
                for j in range(0, done, BATCH):
                    step(w, around[j:j + BATCH], goal[j:j + BATCH], rate)
                around, goal, n = around[done:], goal[done:], n + done
        if len(goal):
            step(w, around, goal, rate)
            n += len(goal)
        if n:
            parts = [(w.flat() * n)[i:i + _CHUNK] for i in range(0, _LENGTH, _CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.list_(pa.float64()))], names=kind.names)

    dealt = rows.where("n_tokens > 0").select("place", "ids").repartition(parts, "place").sortWithinPartitions("place")
    each = dealt.select("ids").mapInArrow(learn, kind)
    each = each.select("chunk", "positions", F.posexplode("weights").alias("place", "weight"))
    mean = each.groupBy("chunk", "place").agg((F.sum("weight") / F.sum("positions")).alias("weight")).toPandas()  # one number per weight
    if mean.empty:
        return flat
    out = flat.copy()
    out[(mean["chunk"] * _CHUNK + mean["place"]).to_numpy(np.int64)] = mean["weight"].to_numpy(float)
    return out


def fit(rows: DataFrame, classes: Classes, rounds: int = ROUNDS, rate: float = 2.8) -> tuple[Classes, np.ndarray]:
    """The model of coded documents."""
    parts = parts_for(rows.agg(F.sum("n_tokens")).first()[0] or 0)
    flat = Weights.start(classes.mass).flat()
    for k in range(rounds):
        flat = trained_round(rows, parts, classes, flat, rate / (k + 1), k, rounds)
    return classes, flat


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, rate: float = 2.8) -> tuple[Classes, np.ndarray]:
    classes = vocabulary(docs, text_col)
    return fit(coded(docs, classes.words, id_col, text_col), classes, rounds, rate)


def pseudo_likelihood(ids: Column, model: tuple[Classes, np.ndarray]) -> Column:
    """The summed conditional log-probabilities of a document's tokens; words of the tail count here as mentioned never."""
    classes, flat = model
    flat = flat.astype(np.float32)
    of = classes.of
    fixed = classes.share.copy()
    fixed[HEAD:] += classes.words.one

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = Weights.of(flat)
        for batch in batches:
            ids, lengths = token_rows(batch)
            row, where, _ = laid_out(ids, lengths)
            value = np.empty(len(ids))
            for i in range(0, len(ids), SCORED):
                some = ids[i:i + SCORED]
                value[i:i + len(some)] = log_probabilities(w, surroundings(row, where[i:i + SCORED]), of[some]) + fixed[some]
            text = np.repeat(np.arange(len(lengths)), lengths)
            yield pa.array(np.bincount(text, value, len(lengths)).astype(np.float64))

    return score(ids)


def likelihoods(rows: DataFrame, model: tuple[Classes, np.ndarray]) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood) of coded documents; words of the tail are joined to the table by word."""
    seen = model[0].words.table.select("word", F.log(F.col("n") + 1).alias("more"))
    more = rows.select("row", F.explode("rare").alias("word")).join(seen, "word").groupBy("row").agg(F.sum("more").alias("more"))
    each = rows.select("row", "doc_id", "n_tokens", pseudo_likelihood(F.col("ids"), model).alias("log_likelihood"))
    return each.join(more, "row", "left").select("doc_id", "n_tokens", (F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))).alias("log_likelihood"))


def scored(docs: DataFrame, model: tuple[Classes, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return likelihoods(coded(docs, model[0].words, id_col, text_col), model)


def op7_masked_likelihood(spark, folder):
    docs = documents(spark, folder)
    classes = vocabulary(docs, "text")
    rows = coded(docs, classes.words)
    d = likelihoods(rows, fit(rows, classes))
    return d.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
