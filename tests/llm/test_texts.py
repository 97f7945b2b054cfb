"""Operators 4, 6, 7 and 10, a row for each text."""

import hashlib
import math
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest_rows import hard_rows, table_of
from millrace.llm.boosted_trees import boost, isotonic
from millrace.llm.masked_likelihood import CLASSES, GROUPS, HEAD, INPUTS, OWN_INPUTS, PER, TOKENS, Classes, Weights, coded as lm_coded, laid_out, log_probabilities, op7_masked_likelihood, parts_for, pseudo_likelihood, scored, step, tail_token, surroundings, train as train_lm
from millrace.llm.quality_divergence import accepted, judge, op10_quality_divergence, repeated_words, text_stats
from millrace.llm.sentencepiece_chunks import ChunkTable, coded, decode, default_model, encode, op4_sentencepiece_chunks, processor, separable
from millrace.llm.toxicity_trees import held_out, op6_toxicity_trees, toxicity, train


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op4_equals_the_library(spark, folder, texts):
    lib = processor(default_model())
    assert separable(default_model())
    got = op4_sentencepiece_chunks(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" ▁ab\n.é漢😀\x00", max_size=14), max_size=4), st.integers(0, 6))
def test_chunks_encode_like_whole_texts(texts, rows):
    table = ChunkTable(default_model(), rows)
    for _ in range(2):
        ids, sizes = table.encode(texts)
        ends = np.cumsum(sizes)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, sizes, strict=True)] == table.lib.encode(texts)


def test_pieces_of_hard_rows(spark):
    lib = processor(default_model())
    got = table_of(spark, hard_rows()).select("text", encode(F.col("text")).alias("ids")).withColumn("back", decode(F.col("ids"))).collect()
    assert len(got) == len(hard_rows())
    assert all(r.ids == lib.encode(r.text or "") and r.back == lib.decode(r.ids) for r in got)
    assert spark.range(1).select(decode(F.lit(None).cast("array<int>")).alias("d")).first().d == ""
    fused = table_of(spark, hard_rows()).select("text", coded(F.col("text")).alias("c")).collect()
    assert all(r.c.ids == lib.encode(r.text or "") and r.c.n_tokens == len(r.c.ids) and r.c.ids_sha256 == sha(",".join(map(str, r.c.ids))) and r.c.decoded_sha256 == sha(lib.decode(r.c.ids)) for r in fused)


def counts(text):
    words = text.encode().split()
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return [len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)]


def test_op10_counts_equal_brute_force(spark, folder, texts):
    got = op10_quality_divergence(spark, folder).collect()
    assert len(got) == len(texts) and 0 < sum(r.kept for r in got) < len(got)
    for r in got:
        want = counts(texts[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n\t#|é漢", max_size=60))
def test_counts_of_any_text(text):
    assert text_stats(text.encode())[0] == counts(text)


def test_repeated_words():
    assert repeated_words(b"a b c a b c".split()) == 6 and repeated_words(b"a b c d".split()) == 0 and repeated_words(b"a a a a".split()) == 4


def test_distances_equal_brute_force(spark, folder, texts):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    hist = {i: text_stats(t.encode()) for i, t in texts.items()}
    ref = {}
    for i, (c, chars, _) in hist.items():
        if c[0] >= 50:
            ref[lang[i]] = ref.get(lang[i], 0) + chars

    def far(p, q):
        p, q = p / p.sum(), q / q.sum()
        m = (p + q) / 2
        return math.sqrt(max(0, sum(0.5 * x[k] * math.log2(x[k] / m[k]) for x in (p, q) for k in range(len(p)) if x[k] > 0)))

    for r in judge(docs).collect():
        if r.n_words:
            assert abs(r.char_distance - far(hist[r.doc_id][1], ref[lang[r.doc_id]])) < 1e-6


def test_quality_of_hard_rows(spark):
    docs = table_of(spark, hard_rows()).withColumn("lang", F.when(F.col("doc_id") != 3, F.col("lang")))
    got = judge(docs).collect()
    assert len(got) == len(hard_rows()) and all(r.kept is not None for r in got) and not any(r.kept for r in got if r.n_words < 50)
    kept = accepted(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert judge(table_of(spark, [])).count() == 0 and accepted(table_of(spark, [])).count() == 0


def test_word_lists_are_rejected_by_their_words_alone(spark):
    random = np.random.default_rng(4)
    vocabulary = ["".join(random.choice(list("abcdehilmnorstu"), random.integers(3, 9))) for _ in range(900)]
    common = ["the", "of", "and", "to", "in", "is", "was", "for"]

    def prose(n):
        return " ".join(random.choice(common) if random.random() < 0.4 else random.choice(vocabulary) for _ in range(n))

    pages = [(i, prose(n)) for i, n in enumerate([50, 60, 80, 120, 200, 400, 800, 2000] * 5)]
    pages += [(100 + i, " ".join(random.choice(vocabulary, n))) for i, n in enumerate([120, 200, 400, 1200])]
    docs = table_of(spark, pages)
    got = {r.doc_id: r for r in judge(docs).collect()}
    assert all(r.kept for i, r in got.items() if i < 100)
    assert all(not r.kept and not r.base_failed and r.char_distance <= 0.3 for i, r in got.items() if i >= 100)
    assert {r.doc_id for r in accepted(docs).collect()} == {i for i in got if i < 100}


def test_quality_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = op10_quality_divergence(spark, folder).where("not base_failed").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    bad, good = ([r.kept for r in rows if r.quality == k] for k in (0, 1))
    assert sum(bad) <= 0.1 * len(bad) and sum(good) >= 0.98 * len(good)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op6_toxicity_trees(spark, folder)
    both = rows.join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in both) / len(both)
    assert right >= 0.93 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in both)
    assert rows.count() == 1000


def test_toxicity_of_hard_rows(spark):
    rows = hard_rows() + [(100 + i, "you are an idiot " + "quiet words here " * (i % 7)) for i in range(60)] + [(200 + i, "some quiet words here " * (1 + i % 7)) for i in range(60)]
    docs = table_of(spark, rows)
    labels = spark.createDataFrame([(i, 1 if i < 200 else 0) for i in range(100, 260)] + [(None, 1), (1, None)], "doc_id long, toxic int")
    got = docs.select("doc_id", held_out(F.col("doc_id")).alias("h"), toxicity(F.col("text"), train(docs, labels)).alias("s")).collect()
    assert len(got) == len(rows) and all(0 <= r.s <= 1 for r in got)
    assert all((r.s >= 0.5) == (r.doc_id < 200) for r in got if r.doc_id and r.doc_id >= 100)
    assert [r.s for r in docs.select(toxicity(F.col("text"), train(docs, labels.limit(0))).alias("s")).collect()] == [0.0] * len(rows)
    none = table_of(spark, [])
    assert none.select(toxicity(F.col("text"), train(none, labels))).count() == 0


def test_trees_and_isotonic():
    random = np.random.default_rng(1)
    x = random.normal(size=(800, 3))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    model = boost(x[:600], y[:600], trees=60)
    assert ((model.raw(x[600:]) > 0) == y[600:]).mean() > 0.95
    at, value = isotonic(np.array([3.0, 1, 2, 2, 4]), np.array([0.0, 0, 1, 0, 1]))
    assert at.tolist() == [1, 2, 3, 4] and np.allclose(value, [0, 1 / 3, 1 / 3, 1])
    assert not boost(x, np.zeros(800)).trees


def test_gradient_of_the_window_network():
    random = np.random.default_rng(2)
    classes = Classes.by_frequency(random.integers(0, 50, TOKENS).astype(float))
    assert abs(classes.mass.sum() - 1) < 1e-9 and classes.of.max() == CLASSES - 1
    assert all(abs(np.exp(classes.share[classes.of == c]).sum() - 1) < 1e-6 for c in (0, 70, CLASSES - 1))
    ids = random.integers(0, TOKENS, 40)
    row, where, _ = laid_out(ids, np.array([25, 0, 15]))
    around, goal = surroundings(row, where), classes.of[ids]
    w = Weights.start(classes.mass)
    loss = lambda v: -log_probabilities(v, around, goal).mean()
    rate, stepped = 1e-3, Weights.of(w.flat())
    before = loss(w)
    step(stepped, around, goal, rate)
    moved = stepped.flat() - Weights.of(w.flat()).flat()
    assert loss(stepped) < before
    for k in np.argsort(-np.abs(moved))[[0, 10, 100]]:  # a step is minus the rate times the gradient
        bumped = w.flat()
        bumped[k] += 1e-2
        assert abs((loss(Weights.of(bumped)) - before) / 1e-2 + moved[k] / rate) < 0.05 * abs(moved[k] / rate) + 1e-3


def around_by_hand(ids, i):
    """The inputs two places to both sides of place ``i`` of one text."""
    inputs = [t if t < OWN_INPUTS else OWN_INPUTS + t % (INPUTS - OWN_INPUTS) for t in ids]
    return [inputs[k] if 0 <= k < len(ids) else INPUTS for k in (i - 2, i - 1, i + 1, i + 2)]


def test_every_position_is_laid_out_once_among_its_own_text():
    random = np.random.default_rng(3)
    texts = [random.integers(0, TOKENS, n).tolist() for n in (0, 1, 2, 7, 0, 65, 3)]
    row, where, inside = laid_out(np.array(sum(texts, []), np.int32), np.array([len(t) for t in texts]))
    assert surroundings(row, where).tolist() == [around_by_hand(t, i) for t in texts for i in range(len(t))]
    assert inside.tolist() == [i for t in texts for i in range(len(t))]
    assert [parts_for(n) for n in (0, 1, 1 << 21, (1 << 21) + 1, 1 << 60)] == [1, 1, 1, 2, 1 << 16]


def test_scores_equal_those_by_hand(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60").select("doc_id", "text").union(table_of(spark, hard_rows()).select("doc_id", "text"))
    model = train_lm(docs)
    classes, w = model[0], Weights.of(model[1])
    n = {bytes(r.word): r.n for r in classes.words.table.collect()}
    together = Counter()
    for word in n:
        if word not in classes.words.head:
            together[tail_token(word)] += n[word] + 1

    def by_hand(text):
        words, value = (text or "").encode().split(), 0.0
        ids = [classes.words.head[x] for x in words]
        for i, (word, token) in enumerate(zip(words, ids, strict=True)):
            h = np.tanh(w.bias + sum(w.embed[a] * w.place[k] for k, a in enumerate(around_by_hand(ids, i))))
            group, c = divmod(int(classes.of[token]), PER)
            for score, at in ((h @ w.group + w.group_bias, group), (h @ w.out[group] + w.out_bias[group], c)):
                value += float(score[at] - np.log(np.exp(score.astype(float)).sum()))
            value += classes.share[token] + (math.log((n[word] + 1) / (together[token] + 1)) if token >= HEAD else 0)
        return len(words), value

    got = sorted((r.n_tokens, r.log_likelihood) for r in scored(docs, model).collect())
    want = sorted(by_hand(r.text) for r in docs.collect())
    assert GROUPS * PER == CLASSES and [a[0] for a in got] == [b[0] for b in want]
    assert all(abs(a[1] - b[1]) < 1e-3 + 1e-5 * abs(b[1]) for a, b in zip(got, want, strict=True))


def test_scores_do_not_depend_on_the_split(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one, other = train_lm(docs.coalesce(1))[1], train_lm(docs.repartition(7))[1]
    assert np.allclose(one, other, rtol=1e-4, atol=1e-6)


def test_training_learns_between_the_strides(spark):
    random = np.random.default_rng(5)
    pairs = lambda: " ".join(f"left{i} right{i}" for i in random.integers(0, 6, 3))
    docs = table_of(spark, [(i, f"edge {pairs()} end") for i in range(3000)])  # eight words each, of which the first is the same
    classes, flat = train_lm(docs)
    rows = lm_coded(docs, classes.words)
    mean = lambda weights: rows.select(pseudo_likelihood(F.col("ids"), (classes, weights)).alias("s")).agg(F.avg("s")).first()[0]
    assert mean(flat) > mean(Weights.start(classes.mass).flat()) + 1


def test_words_of_the_tail_score_by_their_own_counts(spark):
    names = [f"w{i}" for i in range(HEAD)]
    docs = [(i, " ".join(names[i:i + 2000] * 6)) for i in range(0, HEAD, 2000)]  # they fill the head
    often = "rare"
    seldom = next(w for w in (f"x{i}" for i in range(10**6)) if tail_token(w.encode()) == tail_token(b"rare"))
    unseen = next(w for w in (f"y{i}" for i in range(10**6)) if tail_token(w.encode()) == tail_token(b"rare"))
    model = train_lm(table_of(spark, docs + [(-1, " ".join([often] * 4 + [seldom]))]))
    got = {r.doc_id: r.log_likelihood for r in scored(table_of(spark, [(1, often), (2, seldom), (3, unseen), (4, None)]), model).collect()}
    assert abs(got[1] - got[3] - math.log(5)) < 1e-6 and abs(got[2] - got[3] - math.log(2)) < 1e-6 and got[4] == 0
    assert model[0].words.table.count() == HEAD + 2


def test_op7_scores(spark, folder, texts):
    got = op7_masked_likelihood(spark, folder).collect()
    assert len(got) == len(texts) and all(r.n_tokens == len(texts[r.doc_id].encode().split()) and r.log_likelihood <= 0 for r in got)
    docs = table_of(spark, hard_rows())
    model = train_lm(docs)
    rows = scored(docs, model).collect()
    assert len(rows) == len(hard_rows()) and all((r.log_likelihood == 0) == (r.n_tokens == 0) for r in rows)
    none = table_of(spark, [])
    assert scored(none, train_lm(none)).count() == 0
