"""Operators 1 and 5, both native."""

import hashlib
import re

from pyspark.sql import functions as F

from conftest_rows import base_spans as base, hard_rows, table_of
from millrace.llm.secret_ownership import op1_secret_ownership, redacted, report
from millrace.llm.surrogates import assigned, check_digit, op5_surrogates, replaced

def no_python(df):
    plan = df._jdf.queryExecution().toString()
    return "Python" not in plan and "Arrow" not in plan


def test_op1_equals_brute_force(spark, texts, folder):
    df = op1_secret_ownership(spark, folder)
    assert no_python(df)
    got = df.collect()
    assert len(got) == len(texts)
    for r in got:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(",")) | {""}
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex"))


def test_spans_hold_code_points_and_failing_matches_block(spark):
    rows = [(1, "é😀 token=secret:abcdefghijk"), (2, "Password = 'Abcd1234+/'; API_KEY:short"), (3, "AKIA" + "A" * 11 + " AKIA" + "B" * 12 + "x"), (4, "f" * 31 + " " + "0" * 33)]
    got = {r.doc_id: r for r in report(table_of(spark, rows)).collect()}
    for i, t in rows:
        assert got[i].base_sha256 == hashlib.sha256(",".join(base(t)).encode()).hexdigest(), (t, got[i].spans, base(t))


def test_only_tokens_of_few_owners_are_added(spark):
    live, copied = "Zx81Qw72Er63Ty54Ui45", "Aq12Sw23De34Fr45Gt56"
    rows = [(i, f"see {copied} now", "en", f"s{i}") for i in range(5)] + [(9, f"see {live} now", "en", "s9"), (10, "-----BEGIN RSA PRIVATE KEY-----", "en", None)]
    got = {r.doc_id: r for r in report(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[9].spans == "token:4:24" and got[9].n_live == 1 and got[9].n_added == 1
    assert all(got[i].spans == "" and got[i].n_added == 0 for i in range(5))
    assert got[10].spans == "key:0:31"


def test_secrets_of_hard_rows(spark):
    rows = hard_rows() + [(20, "token=abcdefgh1 token=abcdefgh2"), (20, "token=abcdefgh1 token=abcdefgh2")]
    docs = table_of(spark, rows)
    assert report(docs).count() == len(rows)
    out = redacted(docs)
    assert out.columns == docs.columns and no_python(out)
    got = out.collect()
    assert len(got) == len(rows)
    assert sorted(r.text for r in got if r.doc_id == 20) == ["[secret] [secret]"] * 2
    assert sorted(str(r.text) for r in got if r.doc_id != 20) == sorted(str(t) for _, t in hard_rows())
    assert report(table_of(spark, [])).count() == 0 and redacted(table_of(spark, [])).count() == 0


def test_surrogates_keep_type_format_and_mentions(spark):
    text = ("Mr. John Smith and Mrs Jane Smith: +1 (456) 555-2186, JOHN.01@Mail2.example.com or john.01@mail2.example.com, "
            "4539 5787 6362 1486 or 4539578763621486, 10.1.2.3, 123-45-6789, DE89 3704 0044 0532 0130 00, Г-жа Анна Иванова.")
    row = replaced(table_of(spark, [(1, text), (2, "again 4539578763621486")])).orderBy("doc_id").collect()
    new = [(e.kind, e.new) for e in row[0].replacements]
    by = {}
    for k, v in new:
        by.setdefault(k, []).append(v)
    assert by["surname"][0] == by["surname"][1] != "Smith" and by["given_m"][0][-1] == "n" and by["given_f"][0].endswith("na") and re.fullmatch("[А-Я][а-я]+на", by["given_f"][1])
    assert by["email"][0].lower() == by["email"][1] and re.fullmatch(r"[a-z]{4}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", by["email"][1])
    card = by["card"][1]
    digits = [int(c) for c in card]
    assert by["card"][0].replace(" ", "") == card and card[0] == "4" and re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", by["card"][0])
    assert sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", by["phone"][0]) and re.fullmatch(r"\d{3}-\d\d-\d{4}", by["social"][0])
    assert all(0 < int(x) < 256 for x in by["ip"][0].split(".")) and re.fullmatch(r"DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d", by["account"][0])
    assert row[1].text == f"again {card}" and "4539578763621486" not in row[0].text and "Smith" not in row[0].text


def test_surrogates_are_distinct_and_no_entities(spark):
    found = spark.range(900).select(F.lit("ip").alias("kind"), F.concat_ws(".", F.lit("1"), F.lit("2"), (F.col("id") / 250).cast("int").cast("string"), (F.col("id") % 250).cast("string")).alias("norm"))
    tight = spark.range(10).select(F.lit("phone").alias("kind"), F.concat(F.lit("+4"), F.col("id").cast("string")).alias("norm"))
    got = assigned(found.union(tight), "k").collect()
    assert len(got) == 910 and len({(r.kind, r.surrogate) for r in got}) == 910 and not {(r.kind, r.surrogate) for r in got} & {(r.kind, r.norm) for r in got}


def test_check_digit(spark):
    assert spark.range(1).select(check_digit(F.lit("7992739871"))).first()[0] == 3


def test_op5_and_hard_rows(spark, folder, texts):
    df = op5_surrogates(spark, folder)
    assert no_python(df)
    got = df.collect()
    assert len(got) == len(texts)
    assert all(r.text == texts[r.doc_id] for r in got if not r.n_replaced) and all(r.text != texts[r.doc_id] for r in got if r.n_replaced)
    numbers = re.compile(r"(?<![\w+.-])\d{16}(?!\w)|[a-z.]+\d+@mail\d+\.example\.com")
    before = {m for t in texts.values() for m in numbers.findall(t)}
    assert before and not before & {m for r in got for m in numbers.findall(r.text)}
    hard = table_of(spark, hard_rows())
    out = replaced(hard)
    assert out.columns == [*hard.columns, "replacements"]
    assert sorted(map(str, (r.text for r in out.collect()))) == sorted(str(t) for _, t in hard_rows())
    assert replaced(table_of(spark, [])).count() == 0


def test_later_mentions_of_a_name_get_its_surrogate(spark):
    from millrace.llm.surrogates import replaced

    docs = table_of(spark, [(1, "Mr John Smith came. Smith said that John's dog and Smithson left."), (2, "Smith is here."), (3, "Dr Jane Miller met Miller.")])
    got = {r.doc_id: r.text for r in replaced(docs).collect()}
    words = got[1].split()
    assert words[4] == words[2].rstrip(".") and words[7] == words[1] + "'s" and words[10] == "Smithson" and "Smith " not in got[1] and "John" not in got[1]
    assert got[2] == "Smith is here." and "Miller" not in got[3] and "Jane" not in got[3]


def test_one_text_with_very_many_labels_matches_and_spans(spark):
    """Long texts that used to recurse or to copy what was found for each match."""
    import time

    rows = [(1, "x@" + "a." * 100_000), (2, "a." * 100_000 + "@b.com"), (3, " ".join(f"password=Abcdefg{i:06d}" for i in range(30_000))), (4, " ".join(f"user{i}@mail{i}.example.com" for i in range(20_000)))]
    docs = table_of(spark, rows)
    start = time.time()
    got = {r.doc_id: r for r in report(docs.where("doc_id = 3")).collect()}
    assert got[3].n_assign == 30_000 and got[3].spans.split(",")[-1] == "assign:689977:689999"
    hidden = redacted(docs.where("doc_id = 3")).first().text
    assert hidden == " ".join(["[secret]"] * 30_000)
    out = {r.doc_id: r for r in replaced(docs.where("doc_id <> 3")).collect()}
    assert out[1].text == rows[0][1] and len(out[4].replacements) == 20_000 and not re.search(r"\buser\d+@mail\d+\.example", out[4].text) and len(set(out[4].text.split())) == 20_000
    assert time.time() - start < 150


def test_sums_and_pieces(spark):
    from millrace.llm.common import rewritten, sums_before

    for n in (0, 1, 255, 256, 257, 1000):
        row = spark.createDataFrame([([i % 7 for i in range(n)],)], "x array<bigint>").select(sums_before(F.col("x")).alias("s")).first()
        assert row.s == [sum(i % 7 for i in range(k)) for k in range(n)]
    text = "é😀x" * 3000
    spans = [(1, 0, 2, "A"), (1, 4090, 4100, "B"), (1, 4100, 4101, ""), (1, 4200, 8400, "C"), (1, 8999, 9000, "D"), (2, 0, 9000, "E")]
    want = {1: "A" + text[2:4090] + "B" + text[4101:4200] + "C" + text[8400:8999] + "D", 2: "E", 3: text}
    got = rewritten(spark.createDataFrame([(i, text) for i in (1, 2, 3)], "row long, text string"), spark.createDataFrame(spans, "row long, start long, end long, new string"))
    assert {r.row: r.text for r in got.collect()} == want
