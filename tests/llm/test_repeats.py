"""Operators 2 and 3 against brute force over all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.relative_lz import factors, op3_relative_lz, without_copies
from millrace.llm.repeats import Shape, merged, run_hashes, sliding_least
from millrace.llm.suffix_dedup import op2_suffix_dedup, previous_factors, previous_smaller, without_repeats

from conftest_rows import hard_rows, table_of


def sha(b):
    return hashlib.sha256(b).hexdigest()


def bytes_left(docs, length, first):
    """{row: (bytes, removed, spans, kept)} over distinct (id, text) rows in order."""
    rows = sorted({(2 ** 63 - 1 if i is None else i, (t or "").encode()) for i, t in docs})
    count = Counter(t[a:a + length] for _, t in rows for a in range(len(t) - length + 1))
    seen, out = set(), {}
    for i, t in rows:
        mark = bytearray(len(t))
        for a in range(len(t) - length + 1):
            w = t[a:a + length]
            if (w in seen) if first else count[w] > 1:
                mark[a:a + length] = b"\1" * length
            seen.add(w)
        out[i, t] = (len(t), sum(mark), len([x for x in bytes(mark).split(b"\0") if x]), sha(bytes(c for c, m in zip(t, mark) if not m)))
    return out


def words_left(docs, length):
    rows = sorted({(2 ** 63 - 1 if i is None else i, (t or "").encode()) for i, t in docs})
    seen, out = set(), {}
    for i, t in rows:
        w = t.split()
        mark = [0] * len(w)
        for a in range(len(w) - length + 1):
            k = tuple(w[a:a + length])
            if k in seen:
                mark[a:a + length] = [1] * length
            seen.add(k)
        out[i, t] = (len(w), sum(mark), sha(b" ".join(x for x, m in zip(w, mark) if not m)))
    return out


def test_op2_equals_brute_force(spark, folder, texts):
    want = bytes_left(texts.items(), 200, False)
    got = op2_suffix_dedup(spark, folder).collect()
    assert len(got) == len(texts) and sum(r.n_removed for r in got) > 0
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {i: v for (i, _), v in want.items()}


def test_op3_equals_brute_force(spark, folder, texts):
    want = words_left(texts.items(), 20)
    got = op3_relative_lz(spark, folder).collect()
    assert len(got) == len(texts) and sum(r.n_removed for r in got) > 0
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {i: v for (i, _), v in want.items()}


@pytest.mark.parametrize("hot", [20_000, 0])
@pytest.mark.parametrize("keep", ["first", "none"])
def test_hard_rows_of_bytes(spark, keep, hot):
    """Identifiers repeat and are missing, runs of one letter, nulls; pooled anchors and aggregated ones agree."""
    rows = [(i, t) for i, t in hard_rows() if i not in (1, None)] + [(None, "y" * 700), (2, "z" + "x" * 300)]
    want = bytes_left(rows, 60, keep == "first")
    got = without_repeats(table_of(spark, rows), 60, keep, hot=hot).select(
        "doc_id", "bytes", F.length("bytes").alias("n"), "n_removed", "n_spans", F.sha2("kept", 256).alias("s")).collect()
    assert len(got) == len(rows)
    if keep == "none":
        for r in got:
            assert want[2 ** 63 - 1 if r.doc_id is None else r.doc_id, bytes(r.bytes)] == (r.n, r.n_removed, r.n_spans, r.s)
    else:  # rows of one identifier are ordered by a hash, so only the sum is known
        assert sum(r.n_removed for r in got if r.doc_id not in (2, None)) == sum(v[1] for (i, _), v in want.items() if i not in (2, 2 ** 63 - 1))


@pytest.mark.parametrize("hot", [20_000, 0])
def test_hard_rows_of_words(spark, hot):
    rows = hard_rows()
    want = words_left(rows, 20)
    got = without_copies(table_of(spark, rows), 20, hot=hot).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("s")).collect()
    assert len(got) == len(rows)
    by_id = {i: v for (i, _), v in want.items() if i != 2 ** 63 - 1}
    assert all(by_id[r.doc_id] == (r.n_words, r.n_removed, r.s) for r in got if r.doc_id is not None)
    assert {(r.n_words, r.n_removed) for r in got if r.doc_id is None} == {v[:2] for (i, _), v in want.items() if i == 2 ** 63 - 1}


def test_empty_table(spark):
    none = table_of(spark, [])
    assert without_repeats(none, 50).count() == 0 and without_copies(none, 20).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80), st.integers(1, 9))
def test_sliding_least(values, width):
    x = np.array(values, np.uint64)
    if len(x) >= width:
        assert sliding_least(x, width).tolist() == [min(values[i:i + width]) for i in range(len(x) - width + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 12))
def test_run_hashes_tell_runs_apart(values, length):
    h = run_hashes(np.array(values, np.uint64) + np.uint64(1), length)
    runs = [tuple(values[i:i + length]) for i in range(len(values) - length + 1)]
    assert len(h) == len(runs) and len(set(h.tolist())) == len(set(runs))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60))
def test_previous_smaller_and_factors(values):
    x = np.array(values)
    assert previous_smaller(x).tolist() == [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(len(values))] or len(set(values)) < len(values)
    hit = previous_factors(x.astype(np.uint64))
    assert [k >= 0 for k in hit] == [v in values[:i] for i, v in enumerate(values)]
    assert all(k < 0 or values[k] == values[i] for i, k in enumerate(hit))


def test_every_window_has_one_anchor():
    tokens = np.arange(1, 2000, dtype=np.uint64) * np.uint64(7919)
    _, _, low, high = Shape.of(40, True).anchors(tokens)
    assert low[0] == 0 and high[-1] == len(tokens) - 40 and (low[1:] == high[:-1] + 1).all()


def test_factors_run_on_and_cross_boundaries():
    index = {5: ([4, 5, 6, 7], 1), 6: ([4, 5, 6, 7], 2), 9: ([9], 0)}
    assert factors([1, 5, 6, 7, 9, 2], index) == [(1, 3), (4, 4)]


def test_merged_ranges():
    start, end = merged(np.array([10 * 65536 + 5, 12 * 65536 + 20, 32 * 65536 + 1, 0 * 65536 + 3]))
    assert start.tolist() == [0, 10] and end.tolist() == [3, 33]
