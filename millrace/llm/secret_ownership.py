"""Secret scan with corpus-wide ownership frequency, in native functions only.

Patterns find the base spans; further candidates are private-key headers and
unlabelled tokens that mix letters and digits.  All candidate values are hashed
and counted over the whole corpus by distinct owners and distinct repositories.
A value that many owners share is a widely copied example; a value of few owners
that looks drawn at random is a live-looking credential.  Base spans always
stay; an unlabelled token becomes a span only if it is live-looking and touches
no base span.

Positions are code points, the end exclusive.  They come from the pieces between
the matches, so a text is read whole and no limit on its length or matches holds.

Nulls and edges: a NULL text is empty; a NULL owner or repository counts as one
value of its own; rows that repeat are scanned each, in the order of no key; a
NULL identifier stays NULL; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import documents, once, rewritten, staged, sums_before

# The base patterns.  Hex and access runs are maximal, so their least length can stand in the pattern.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KEY = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"

KINDS = ("assign", "access", "hex", "key", "token")
BASE = 3
HINTS = ("passw", "secret", "token", "api")
SPAN = "array<struct<start:bigint,end:bigint,kind:int,value:string>>"
JUDGED = "array<struct<start:bigint,end:bigint,kind:int,shared:boolean,live:boolean,n_owners:bigint>>"


def _none() -> Column:
    return F.array().cast(SPAN)


def match_spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """The matches of a pattern from left to right; their values are those of the group."""
    p = F.lit(pattern)
    hits = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("hit"),
                        F.regexp_extract_all(text, p, F.lit(group)).alias("value"))
    matched = F.filter(hits, lambda x: x["hit"].isNotNull())  # the gap after the last match has none

    def spans(found: Column) -> Column:
        before = sums_before(F.transform(found, lambda x: (F.length(x["gap"]) + F.length(x["hit"])).cast("bigint")))
        return once(before, lambda b: F.transform(found, lambda x, i: F.struct(
            (F.get(b, i) + F.length(x["gap"])).alias("start"), (F.get(b, i) + F.length(x["gap"]) + F.length(x["hit"])).alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))))

    return once(matched, spans).cast(SPAN)


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def candidates(text: Column) -> Column:
    """All candidate spans of a text; rare signs are looked for first, so most texts pass no slow pattern."""
    low = F.lower(text)
    hint = F.lit(False)
    for word in HINTS:
        hint = hint | low.contains(word)
    assign = F.when(hint, F.filter(match_spans(text, ASSIGN, 0, 2), lambda x: F.length(x["value"]) >= 8)).otherwise(_none())
    access = F.when(text.contains("AKIA"), match_spans(text, ACCESS, 1)).otherwise(_none())
    hexes = F.when(text.rlike(HEX), match_spans(text, HEX, 2)).otherwise(_none())
    keys = F.when(text.contains("PRIVATE KEY-----"), match_spans(text, KEY, 3)).otherwise(_none())
    tokens = F.when(text.rlike(TOKEN), F.filter(match_spans(text, TOKEN, 4), lambda x: _mixed(x["value"]))).otherwise(_none())
    return F.concat(assign, access, hexes, keys, tokens)


def live_looking(value: Column, least_signs: int = 8) -> Column:
    """Long enough, letters with digits, and many different signs: not a word, number or placeholder."""
    signs = F.size(F.array_distinct(F.split(F.lower(value), "")))
    return (F.length(value) >= 16) & _mixed(value) & (signs >= least_signs) & ~F.lower(value).rlike("example|sample|placeholder|changeme|xxxx|0123456789|abcdefgh")


def ownership(found: DataFrame) -> DataFrame:
    """Per value its distinct owners and repositories, counted in steps that each combine before they shuffle."""
    each = found.groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = each.groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("n").alias("n_found"))


def _text(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kind, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _in_order(spans: Column) -> Column:
    """Sorted by start, then kind."""
    return F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))


def scanned(docs: DataFrame, text_col: str = "text", repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """The input rows with a row number and their candidates, staged; the row number is that of the written table."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = F.transform(candidates(text), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), F.sha2(x["value"], 256).alias("value_hash"), live_looking(x["value"]).alias("live")))
    repository = F.concat_ws("/", F.col("source"), F.col("lang")) if repository is None else repository
    owner = F.col("source") if owner is None else owner
    return docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), spans.alias("candidates"))


def judged(rows: DataFrame, most_owners: int = 2) -> DataFrame:
    """Per row with candidates: its spans and how its values stand in the corpus.

    A value that fills a third of the table is counted by combining, and the
    join back to its places is one Spark splits.
    """
    found = rows.select("row", "owner", "repository", F.explode("candidates").alias("c")).select("row", "owner", "repository", "c.*")
    counts = ownership(found)
    each = found.join(counts, "value_hash").withColumn("shared", F.col("n_owners") > most_owners)
    # a token is free if no span before it reaches into it and none starts within it
    line, back = Window.partitionBy("row").orderBy("start"), Window.partitionBy("row").orderBy(F.col("start").desc())
    other = F.col("kind") < BASE + 1
    into = F.max(F.when(other, F.col("end"))).over(line.rangeBetween(Window.unboundedPreceding, 0))
    within = F.min(F.when(other, F.col("start"))).over(back.rangeBetween(Window.unboundedPreceding, 0))
    free = F.coalesce(into <= F.col("start"), F.lit(True)) & F.coalesce(within >= F.col("end"), F.lit(True))
    kept = each.withColumn("free", free).where(other | (F.col("live") & ~F.col("shared") & F.col("free")))
    span = F.struct("start", "end", "kind", "shared", F.col("live").alias("live"), "n_owners")
    return kept.groupBy("row").agg(F.collect_list(span).alias("spans"))


def report(docs: DataFrame, id_col: str = "doc_id", most_owners: int = 2) -> DataFrame:
    """One row per document: base counts and digest, all spans, and the corpus-wide verdicts."""
    all_rows = scanned(docs)
    rows = staged(all_rows.select("row", F.col(f"doc.{id_col}").alias("doc_id"), "owner", "repository", "candidates"), "secret-candidates")
    d = rows.select("row", "doc_id", F.filter("candidates", lambda x: x["kind"] < BASE).alias("base")).join(
        judged(rows, most_owners), "row", "left")
    spans = F.coalesce("spans", F.array().cast(JUDGED))
    many = lambda test: F.size(F.filter(spans, test)).cast("bigint")
    of = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint")
    return d.select("doc_id", *[of(k).alias(f"n_{KINDS[k]}") for k in range(BASE)], F.sha2(_text(_in_order(F.col("base"))), 256).alias("base_sha256"),
                    _text(_in_order(spans)).alias("spans"), many(lambda x: x["kind"] >= BASE).alias("n_added"),
                    many(lambda x: x["shared"]).alias("n_copied"), many(lambda x: ~x["shared"] & x["live"]).alias("n_live"))


def _runs(spans: DataFrame, mask: str) -> DataFrame:
    """Spans that overlap made one, with the mask as what replaces them."""
    line = Window.partitionBy("row").orderBy("start", F.col("end").desc())
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")
    runs = spans.withColumn("opens", opens).withColumn("run", F.sum("opens").over(line))
    return runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).withColumn("new", F.lit(mask))


def redacted(docs: DataFrame, text_col: str = "text", mask: str = "[secret]", most_owners: int = 2) -> DataFrame:
    """The documents with every span of :func:`judged` masked; rows without a candidate pass as they are.

    Texts with candidates are joined to the verdicts; the others never move.
    """
    rows = staged(scanned(docs, text_col), "secret-rows")
    clean = rows.where(F.size("candidates") == 0).select("doc.*")
    dirty = rows.where(F.size("candidates") > 0)
    spans = judged(rows, most_owners).select("row", F.explode("spans").alias("s")).select("row", "s.start", "s.end")
    texts = dirty.select("row", F.col(f"doc.`{text_col}`").alias("text"))
    new = rewritten(texts, _runs(spans, mask)).withColumnRenamed("text", "new_text")
    others = F.struct(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != text_col], F.lit(0).alias("__"))
    hidden = dirty.select("row", others.alias("doc")).join(new, "row")
    return clean.unionByName(hidden.select(*[F.col("new_text").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]))


def op1_secret_ownership(spark, folder):
    return report(documents(spark, folder))
