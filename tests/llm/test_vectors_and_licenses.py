"""Operators 11, 12 and 13."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_rows import hard_rows, table_of
from millrace.llm.centroid_simplex import Simplex, bounds, clusters, nearest, op12_centroid_simplex
from millrace.llm.feast import Inertia, largest_pairs
from millrace.llm.license_rules import BLOCK, licenses, op13_license_rules, resolved
from millrace.llm.license_signatures import BASE_PHRASES, rules
from millrace.llm.whitening_feast import op11_whitening_feast, whitened

SPECTRA = {"spread": lambda d: np.linspace(0.1, 3, d), "ties": lambda d: np.r_[np.ones(d // 2), np.full(d - d // 2, 2.0)], "low rank": lambda d: np.r_[np.zeros(d - min(3, d)), np.arange(1, min(3, d) + 1)],
           "falling": lambda d: 2.0 ** -np.arange(d), "close": lambda d: 1 + 1e-9 * np.arange(d)}


@pytest.mark.parametrize("kind", SPECTRA)
@pytest.mark.parametrize("d", [1, 2, 17, 64])
def test_contour_integration_finds_the_largest_pairs(d, kind):
    q = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    want = np.sort(SPECTRA[kind](d))[::-1]
    a = q * want @ q.T
    a = (a + a.T) / 2
    assert all(Inertia(a).above(s) == (want > s).sum() for s in (0.3, 1.5, 2.5))
    values, axes = largest_pairs(a * 1e9, 16)
    want = want[want > 1e-11][:16] * 1e9
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-9)
    assert np.abs(axes.T @ axes - np.eye(len(want))).max() < 1e-13 and np.abs(a * 1e9 @ axes - axes * values).max() < 1e-3


def test_no_variance_no_pairs():
    assert len(largest_pairs(np.zeros((5, 5)), 3)[0]) == 0 and len(largest_pairs(np.zeros((0, 0)), 3)[0]) == 0


def plain_whitening(rows):
    """x, n, S and all eigenpairs by the library's solver; None for rows that are dropped."""
    xs = [None if v is None or any(c is None or not math.isfinite(c) for c in v) else [math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    fit = np.array(sorted({tuple(x) for x in xs if x is not None}), float)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(fit.shape[1], -1))
    return xs, len(fit), [int(s) for s in fit.sum(0)], values[::-1], axes[:, ::-1]


def check_whitening(got, rows, components):
    xs, n, sums, values, axes = plain_whitening(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id if hasattr(r, "vec_id") else r.id, []).append(r)
    assert len(got) == components * sum(x is not None for x in xs)
    signs = {}
    for (i, _), x in zip(rows, xs, strict=True):
        if x is None:
            continue
        for r in by_id[i][:components] if len(by_id[i]) == components else []:
            k = r.component - 1
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
            assert abs(r.explained - values[k] / values.sum()) < 1e-9 and r.identity_error < 1e-9
            want = (np.array(x) - np.array(sums) / n) @ axes[:, k] / math.sqrt(values[k])
            sign = signs.setdefault(k, 1 if want * r.whitened >= 0 or abs(want) < 1e-6 else -1)
            assert abs(sign * r.whitened - want) < 1e-6


def test_op11_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check_whitening(op11_whitening_feast(spark, folder).collect(), rows, 16)


SCHEMA = "vec_id bigint, embedding array<float>, x int, id string, label int, cluster string"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", 2, "b") for i, v in rows], SCHEMA)


def test_hard_vectors_whitened(spark):
    rng = np.random.default_rng(5)
    base = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(40)]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [math.nan, 0.0, 0.0]), (53, [math.inf, 0.0, 0.0]), (54, [1.0]), (55, []), (56, [3e38, 0.0, 0.0])]
    rows = base + [(99, base[0][1])] * 30 + [(None, base[1][1])]
    got = whitened(vector_table(spark, rows + bad)).collect()
    assert {r.component for r in got} == {1, 2, 3} and len(got) == 3 * len(rows)
    check_whitening([r for r in got if r.id is not None and r.id < 50], base, 3)
    assert whitened(vector_table(spark, [])).count() == 0 and whitened(vector_table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert {r.component for r in whitened(vector_table(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0])])).collect()} == {1}
    far = whitened(vector_table(spark, [(1, [1e15, 0.0]), (2, [-1e15, 5.0])])).collect()
    assert len(far) == 2 and all(r.deviation is None and abs(abs(r.whitened) - 1) < 1e-9 for r in far)


def plain_clusters(rows, k=40, rounds=5, dimensions=64):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and len(v) == dimensions and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in order[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        of = [near(x)[1] for _, x in kept]
        centroids = [[sum(v) // len(v) for v in zip(*[x for (_, x), o in zip(kept, of, strict=True) if o == j], strict=True)] if j in of else c for j, c in enumerate(centroids)]
    return sorted(((i is None, i or 0, *near(x)[::-1]) for i, x in kept)), centroids


def test_op12_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, centroids = plain_clusters(rows)
    got = op12_centroid_simplex(spark, folder).collect()
    assert sorted((r.vec_id is None, r.vec_id, r.cluster, r.distance) for r in got) == want
    total = sum(w[3] for w in want)
    for r in got:
        assert r.inertia == total and r.cluster_inertia == sum(w[3] for w in want if w[2] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_hard_vectors_clustered(spark):
    rng = np.random.default_rng(6)
    base = [(i, [float(c) for c in rng.integers(-3, 4, size=64)]) for i in range(30)]
    flat = [(100 + i, [float(i % 2)] * 64) for i in range(20)]  # on one line, and with many ties
    bad = [(50, None), (51, [None] * 64), (52, [math.nan] * 64), (53, [1.0]), (54, [math.inf] * 64), (55, [1e30] * 64)]
    for rows, k in ((base + [(7, base[3][1])] * 20 + [(None, base[4][1])] + flat, 40), (flat, 5), (base[:1], 40), (base[:5], 2)):
        want, centroids = plain_clusters(rows, k)
        got, found = clusters(vector_table(spark, rows + bad), k=k)
        assert sorted((r.id is None, r.id or 0, r.cluster, r.distance) for r in got.collect()) == want and found.tolist() == centroids
    assert clusters(vector_table(spark, bad))[0].count() == 0 and clusters(vector_table(spark, []))[0].count() == 0


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(8)
    centres = rng.integers(-400, 400, (40, 64))
    x = centres[rng.integers(0, 40, 3000)] + rng.integers(-30, 31, (3000, 64))
    simplex = Simplex.of(centres, 12)
    a, b = simplex.apexes(x), simplex.apexes(centres)
    true = ((x[:, None] - centres[None]) ** 2).sum(2)
    low, high = bounds(a, b)
    assert (low <= true * (1 + 1e-9) + 1e-3).all() and (high >= true * (1 - 1e-9) - 1e-3).all()
    number, far, taken = nearest(x, a, centres, b)
    assert (number == true.argmin(1)).all() and (far == true.min(1)).all() and taken < 0.3 * true.size


# ---- licenses ---------------------------------------------------------------

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_scan(text, known):
    """Every rule at every word, then each finding against all others."""
    w = plain_words(text)
    found = []
    for number, r in enumerate(known):
        for i in range(len(w)):
            m = re.match(f"({r.pattern})(?: |$)", " ".join(w[i:i + 32]))
            if m:
                found.append((r.tier, i, -(i + len(m.group(1).split(" "))), number, r.label))
    kept = [b for b in found if b[0] == 0 or not any(0 < a[0] and a != b and a[1] <= b[1] and a[2] <= b[2] and a[:4] < b[:4] for a in found)]
    base = [(i, label) for tier, i, _, _, label in kept if tier == 0]
    return len(w), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted({f[4] for f in kept}))


TEXTS = ["Licensed under the Apache License, Version 2.0 (the \"License\")", "MIT License", "under CC BY-NC-SA 4.0 and CC-BY", "GNU Lesser General Public License v2.1 or later", "GNU General Public License, version 3",
         "SPDX-License-Identifier: GPL-2.0-only", "Permission is hereby granted, free of charge, to any person obtaining a copy", "mit license mit license mit-licence", "Redistribution and use in source and binary forms",
         "© All rights reserved. Released under the terms of the BSD 3-Clause License", "http://www.apache.org/licenses/LICENSE-2.0", "the GPLv3", "Mit Lizenz", "apacheé license", "gnu\x00general public license", "neither the name of X nor Y may be used to endorse or promote products"]


def test_rules_are_hundreds_and_start_with_their_keyword():
    known = rules()
    assert len(known) > 300 and len(set(known)) == len(known) and [r.pattern for r in known if r.tier == 0] and {r.pattern for r in known if r.tier == 0} == {p for p, _ in BASE_PHRASES}
    assert all(r.pattern.startswith(r.keyword) and 1 <= len(r.keyword.split()) <= 2 for r in known)


def test_licenses_equal_brute_force(spark):
    known = rules()
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200, " so ".join(TEXTS))] + [r for r in hard_rows() if r[1] is None or len(r[1]) < 6000]
    df = licenses(table_of(spark, rows))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = sorted(((r.doc_id is None, r.doc_id or 0), (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)) for r in df.collect())
    assert got == sorted(((i is None, i or 0), plain_scan(t, known)) for i, t in rows)
    labels = {r.doc_id: (r.labels, r.score) for r in df.collect()}
    assert labels[100] == ("apache,apache-2.0", 0.9) and labels[101] == ("mit", 0.7) and labels[103] == ("lgpl-2.1", 0.9) and labels[105] == ("gpl-2.0", 1.0) and labels[112] == ("", 0.0)
    assert licenses(table_of(spark, [])).count() == 0


def test_very_long_text_with_very_many_findings(spark):
    text = "Apache License, Version 2.0. " * 60_000
    r = licenses(table_of(spark, [(1, text)])).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (300_000, 60_000, 0, 299_995, "apache,apache-2.0")


def test_containment_across_blocks(spark):
    rows = [(1, BLOCK - 3, BLOCK + 4, "wide", 2, 0, 0.9), (1, BLOCK - 1, BLOCK + 2, "within", 2, 1, 0.9), (1, BLOCK + 1, BLOCK + 3, "later", 3, 2, 0.9), (1, BLOCK + 2, BLOCK + 6, "over", 3, 3, 0.9),
            (1, BLOCK - 3, BLOCK + 4, "same", 2, 4, 0.9), (2, BLOCK + 1, BLOCK + 3, "other row", 3, 2, 0.9), (1, BLOCK, BLOCK + 1, "base", 0, 9, 0.7), (1, 5, 9, "weak around", 5, 6, 0.6), (1, 6, 8, "strong", 1, 7, 1.0)]
    found = spark.createDataFrame(rows, "row long, start long, end long, label string, tier int, number int, weight double")
    assert {r.label for r in resolved(found).collect()} == {"wide", "over", "other row", "base", "weak around", "strong"}


def test_op13_registered_query(spark, folder, texts):
    known = [r for r in rules() if r.tier == 0]
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in op13_license_rules(spark, folder).collect()}
    assert got == {i: plain_scan(t, known)[:5] for i, t in texts.items()}
    assert op13_license_rules(spark, folder).where(F.col("labels") != "").count() > 0
