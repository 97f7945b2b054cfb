"""Operators 8 and 9 and the pipeline against brute force."""

from collections import Counter, defaultdict

import uuid

import corpus_pipeline
from conftest_rows import hard_rows, table_of
from millrace.session import work_dir
from millrace.llm.components import components
from millrace.llm.minhash_components import bands_for, far_bits, near_components, op8_minhash_components, representatives
from millrace.llm.simhash_windows import decontaminated, matches, op9_simhash_windows


def classes(pairs, nodes):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text, width):
    words = text.encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def similar(sets, percent):
    by, both = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    for group in by.values():
        both.update((min(a, b), max(a, b)) for k, a in enumerate(group) for b in group[:k])
    return [(a, b) for (a, b), n in both.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]


def test_op8_equals_brute_force(spark, folder, texts):
    sets = {i: shingles(t, 3) for i, t in texts.items()}
    want = classes(similar(sets, 85), sets)
    got = op8_minhash_components(spark, folder).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def chained(n):
    """Texts that are like their neighbours only, so a class has links that no leader sees."""
    words = [f"w{k}" for k in range(400)]
    return [(i, " ".join(words[4 * i:4 * i + 100])) for i in range(n)]


def test_classes_of_chains_and_large_groups(spark):
    rows = chained(40) + [(100 + i, "copy " * 3 + "same words stand here in every copy of this text") for i in range(200)]
    sets = {i: shingles(t, 3) for i, t in rows}
    want = classes(similar(sets, 85), sets)
    got = near_components(table_of(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == want and want[39] == 0


def test_near_copies_of_hard_rows(spark):
    docs = table_of(spark, hard_rows())
    got = near_components(docs).collect()
    assert len(got) == len(hard_rows())
    of = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert of == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11, 12: 12}
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    left = representatives(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 1, 4, 5, 6, 7, 9, 10, 11, 12]
    assert near_components(table_of(spark, [])).count() == 0 and representatives(table_of(spark, [])).count() == 0


def test_repeated_rows_leave_one(spark):
    assert representatives(table_of(spark, [(1, "a b c d e f g")] * 3 + [(2, "x y z")])).count() == 2


def test_bands_and_signature():
    assert bands_for(85) == 26 and (1 - 0.8 ** 5) ** bands_for(80) <= 3e-7 and 25 <= far_bits(85) <= 30


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 400)] + [(7, 7), (400, 399)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == classes(edges, {n for e in edges for n in e})
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def words(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def best_windows(docs, items, least=0.8):
    out = {}
    prepared = []
    for j, t in items:
        w = words(t)
        if w:
            k = min(5, len(w))
            prepared.append((j, len(w), k, Counter(tuple(w[a:a + k]) for a in range(len(w) - k + 1))))
    for i, t in docs:
        w = words(t)
        for j, n, k, want in prepared:
            inside = {tuple(w[a:a + k]) for a in range(len(w) - k + 1)}
            if not inside & set(want):
                continue
            best = 0
            for a in range(max(1, len(w) - n + 1)):
                have = Counter(tuple(w[a:a + n][b:b + k]) for b in range(min(n, len(w) - a) - k + 1))
                both = sum((have & want).values())
                best = max(best, both / (sum(have.values()) + sum(want.values()) - both))
            if best >= least:
                out[i, j] = best
    return out


def test_op9_equals_brute_force(spark, folder, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = best_windows(texts.items(), items)
    df = op9_simhash_windows(spark, folder)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = {(r.doc_id, r.item_id): r.similarity for r in df.collect()}
    assert want and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_edited_passages_short_items_and_hard_rows(spark):
    item = " ".join(f"term{k}" for k in range(60))
    changed = item.split()
    changed[57] = "other"
    rows = [*hard_rows(), (30, "before " + item.upper().replace(" ", ",  ") + " after"), (31, "x " + " ".join(changed) + " y"), (32, " ".join(item.split()[::-1])),
            (33, " ".join(item.split()[3:])), (34, "so one two three go"), (35, " ".join(item.split()[:30]))]
    items = [(1, item), (2, "one two three"), (3, None), (4, " .. "), (5, "a " * 40), (1, item)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = best_windows([r for r in rows if r[0] is not None], items)
    assert {i for i, j in want if j == 1} == {30, 31, 33} and (11, 5) in want and (34, 2) in want
    for block_rows in (500_000, 7):
        got = {(r.doc_id, r.item_id): r.similarity for r in matches(table_of(spark, rows), bench, block_rows=block_rows).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    docs = table_of(spark, rows)
    left = decontaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == sorted(i or 0 for i, _ in rows if i not in {k for k, _ in want})
    assert matches(table_of(spark, []), bench).count() == 0 and matches(docs, bench.limit(0)).count() == 0


def test_pipeline_stages(spark, folder, texts):
    """Each stage against a plain version of its rule, on what the one before kept."""
    from conftest_rows import base_spans
    from millrace.llm.common import documents, staged
    from millrace.llm.quality_divergence import judge
    from millrace.llm.sentencepiece_chunks import default_model, processor

    docs = documents(spark, folder)
    columns = docs.columns
    kept = {r.doc_id for r in judge(docs).collect() if r.kept}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = staged(stage(spark, docs, folder), "test-stage")
        assert docs.columns == columns
        rows = {r.doc_id: r.text for r in before.collect()}
        if name == "quality rules":
            rows = {i: t for i, t in rows.items() if i in kept}
        elif name == "near dedup":
            sets = {i: shingles(t, 5) for i, t in rows.items()}
            rows = {i: rows[i] for i, c in classes(similar(sets, 80), sets).items() if i == c}
        elif name == "benchmark decontamination":
            bad = {i for i, _ in best_windows(rows.items(), items)}
            rows = {i: t for i, t in rows.items() if i not in bad}
        got = {r.doc_id: r.text for r in docs.collect()}
        assert got.keys() == rows.keys(), name
        if name != "secret scans":
            assert got == rows
        else:
            assert all(not base_spans(t) for t in got.values()) and all(got[i] == t for i, t in rows.items() if "[secret]" not in got[i])
    lib = processor(default_model())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id: r.ids for r in last} == {r.doc_id: lib.encode(r.text) for r in docs.collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == {r.doc_id for r in last}


def test_pipeline_on_hard_rows_and_on_none(spark, folder):
    """Every stage on nulls, empty and long texts, repeated rows and further columns, and on an empty table."""
    for rows in (hard_rows(), []):
        docs = table_of(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
            path = f"{work_dir(spark)}/stage-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        got = docs.collect()
        assert bool(got) == bool(rows) and len({r.doc_id for r in got}) == len(got) and all(r.n_tokens == len(r.ids) > 0 for r in got)
