"""License scan by ordered signature rules, in native functions only.

A text becomes its lower-case words.  The keyword prefilter asks of every word,
alone and with the next, whether a rule starts with it; only there a stretch
of ``REACH`` words is cut out, and only the rules of that keyword are tried on it, from its start
on.  So a text costs one pass over its words whatever the number of rules, and a
rule costs a few words wherever it may apply.

A finding is an interval of words with the tier of its rule.  It is suppressed if
an interval of a better tier contains it, or one of its own tier that starts
before it, ends after it or, for equal intervals, comes first in the table; base phrases are
never suppressed and suppress nothing.  Findings are compared in blocks of positions, so a text
with very many is no single group.

The score is that of the best finding kept, by its tier, or 0.

Nulls and edges: a NULL text is empty and has no word, no label and score 0; rows
that repeat are scanned each; a NULL identifier stays NULL; texts of any length are
scanned whole; an empty table gives an empty result.  Of the input only the two named columns are
read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import documents, once, staged
from millrace.llm.license_signatures import WEIGHTS, Rule, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: what stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words that a rule may span; positions of a block in which findings are compared.
REACH, BLOCK = 32, 1024


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN, -1), "")


def places(words: Column, keywords: list[str]) -> Column:
    """Position, keyword and the words from there on, wherever a rule starts."""
    alone, pairs = [k for k in keywords if " " not in k], [k for k in keywords if " " in k]
    heads = sorted({k.split(" ")[0] for k in pairs})
    position = F.transform(words, lambda w, i: F.when(w.isin(alone) | w.isin(heads), i))
    at = F.filter(position, lambda i: i.isNotNull())
    cut = F.transform(at, lambda i: F.struct(i.alias("at"), F.slice(words, i + 1, REACH).alias("w")))
    keys = lambda x: F.array(F.element_at(x["w"], 1), F.concat_ws(" ", F.slice(x["w"], 1, 2)))
    each = F.flatten(F.transform(cut, lambda x: F.transform(F.array_distinct(keys(x)), lambda k: F.struct(
        x["at"].cast("bigint").alias("at"), k.alias("keyword"), F.array_join(x["w"], " ").alias("stretch")))))
    return F.filter(each, lambda x: x["keyword"].isin(alone) | x["keyword"].isin(pairs))


def rule_table(spark: SparkSession, known: list[Rule]) -> DataFrame:
    """The rules with their order and weight; as many rows as there are rules."""
    rows = [(r.keyword, f"^({r.pattern})(?: |$)", r.label, r.tier, k, WEIGHTS[r.tier]) for k, r in enumerate(known)]
    return spark.createDataFrame(rows, "keyword string, pattern string, label string, tier int, number int, weight double")


def findings(stretches: DataFrame, known: DataFrame) -> DataFrame:
    """``row``, ``start`` and ``end`` of every rule that holds at its keyword."""
    tried = stretches.join(F.broadcast(known), "keyword").withColumn("hit", F.expr("regexp_extract(stretch, pattern, 1)")).where(F.col("hit") != "")
    length = F.length("hit") - F.length(F.replace("hit", F.lit(" "), F.lit(""))) + 1
    return tried.select("row", F.col("at").alias("start"), (F.col("at") + length).alias("end"), "label", "tier", "number", "weight")


def resolved(found: DataFrame) -> DataFrame:
    """The findings without those that a better one contains."""
    base, rest = found.where("tier = 0"), found.where("tier > 0")
    first, last = F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK)
    blocks = rest.withColumn("block", F.explode(F.sequence(first, last)))
    order = [F.col("start"), F.col("end").desc(), F.col("number")]
    group = Window.partitionBy("row", "block")
    until = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = group.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    contained = F.lit(False)
    for tier in range(1, len(WEIGHTS)):
        end = F.when(F.col("tier") == tier, F.col("end"))
        better = F.coalesce(F.max(end).over(same) >= F.col("end"), F.lit(False)) & (F.col("tier") > tier)
        equal = F.coalesce(F.max(end).over(until) >= F.col("end"), F.lit(False)) & (F.col("tier") == tier)
        contained = contained | better | equal
    kept = blocks.withColumn("contained", contained).where(~F.col("contained") & (F.col("block") == F.floor(F.col("start") / BLOCK)))
    return base.unionByName(kept.select(*base.columns))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: list[Rule] | None = None) -> DataFrame:
    """Rows of the input by number, with their words counted and the stretches at keywords; staged."""
    keywords = sorted({r.keyword for r in known or rules()})
    seen = once(words_of(F.col(text_col)), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), places(w, keywords).alias("places")))
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), seen.alias("seen"))
    return staged(d.select("row", "doc_id", "seen.*"), "license-stretches")


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: list[Rule] | None = None) -> DataFrame:
    """One row per document: base places, labels and score."""
    known = known or rules()
    rows = scanned(docs, id_col, text_col, known)
    found = findings(rows.select("row", F.explode("places").alias("p")).select("row", "p.*"), rule_table(docs.sparkSession, known))
    kept = resolved(found)
    base = F.when(F.col("tier") == 0, F.col("start"))
    of = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per = kept.groupBy("row").agg(F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
                                  of(F.when(F.col("tier") == 0, F.col("label"))).alias("base_labels"), of(F.col("label")).alias("labels"),
                                  F.max("weight").alias("score"), F.count_if(F.col("tier") > 0).alias("n_found"))
    out = rows.select("row", "doc_id", "n_words").join(per, "row", "left")
    zero = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0, "n_found": 0}
    return out.fillna(zero).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_found")


def op13_license_rules(spark, folder):
    return licenses(documents(spark, folder))
