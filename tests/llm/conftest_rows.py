"""Rows that operators must bear."""

import random
import re

PATTERNS = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m.group(2)) >= 8),
            ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group(0)) >= 16), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group(0)) >= 32)]


def base_spans(text):
    """The base spans of a text as the contract states them."""
    found = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(PATTERNS) for m in p.finditer(text) if ok(m))
    return [f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in found]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, bytes string, row string, spans string, words string, n int"


def table_of(spark, rows):
    """Documents with further columns, whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", None, "x", "y", "z", "w", 7) for i, t in rows], SCHEMA)


def hard_rows():
    """Nulls, empty and blank texts, repeated rows, ties, and a very long text."""
    random.seed(3)
    vocabulary = ["word%d" % i for i in range(400)] + ["é", "漢字", "😀", "the"]
    long = " ".join(random.choices(vocabulary, k=30_000))
    base = " ".join(random.choices(vocabulary, k=120))
    near = base.replace("the", "thé", 1) + " tail"
    return [(1, base), (2, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "one two"), (None, base), (None, "only here"),
            (9, long), (10, "x" * 5000), (11, "a " * 300), (12, long[:4000])]
