"""Replaces personal data by keyed surrogates, in native functions only.

One pattern finds e-mail and IP addresses, card and account numbers, phone and
social-security numbers, and names behind a form of address; further capitalised
mentions of such a name in the same document are found by a join.  Every distinct
entity of the corpus gets one surrogate, so mentions of one person or number
stay mentions of one (coreference), whatever the case or the separators:

* numbers: digits for digits; cards keep issuer digit and check-sum validity,
  phones their country code, addresses of machines stay in range;
* e-mail addresses: letters for letters, digits for digits, the last label stays;
* names: syllables of the script (Latin, Cyrillic), given names with an ending
  of the gender that the form of address tells; a surname is one entity for all
  its bearers.  Each mention keeps its separators and case.

Surrogates come from a keyed hash.  Collision checks: a surrogate that two
entities of a kind share, or that is an entity of the corpus, is drawn again for
all but one of them, round by round until none is left.  From the sixth round on
a surrogate also grows, as a format may hold too few values.

Nulls and edges: a NULL text stays NULL; an empty text is empty; texts of any length
are treated whole, in about their length in time; equal values are one entity wherever they stand; repeated rows are
treated each; entities that a third of the table shares are counted by combining
and joined by a join that Spark can split; an empty table gives an empty result.
Columns of any name pass as they are, but for one named ``replacements``, which the result adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import documents, rewritten, staged
from millrace.llm.secret_ownership import SPAN, match_spans

# Forms of address that tell a gender.
MALE = ("Mr", "Sir", "Lord", "Herr", "Herrn", "Monsieur", "Señor", "Don", "Г-н", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Lady", "Madam", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Doña", "Г-жа", "Госпожа")
NEUTRAL = ("Dr", "Prof", "Doctor", "Professor", "Доктор", "Профессор")

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|\d?\d)"
# The name of a machine has 127 labels at most; with a bound the engine's recursion has one.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}"
IP = rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"
ACCOUNT = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w+])\d(?:[ -]?\d){12,18}(?!\w)"
PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?!\w)"
NAME = rf"(?<!\w)(?:{'|'.join(MALE + FEMALE + NEUTRAL)})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?"
MENTION = r"(?<![\p{L}\d_'-])\p{Lu}[\p{L}'-]*?\p{L}(?=(?:['’]s)?(?![\p{L}\d_'-]))"
ENTITY = "|".join((EMAIL, IP, ACCOUNT, SOCIAL, CARD, PHONE, NAME))
HINT = rf"@|\d\.\d|\d{{3}}|\+\d|\(\d|(?:{'|'.join(MALE + FEMALE + NEUTRAL)})\.? "

KINDS = ("email", "ip", "account", "social", "card", "phone", "given_f", "given_m", "surname")
# Syllables of made-up names.
LATIN = "ba be bi bo da de di do fa fe fi fo ga ge gi go ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi vo".split()
CYRILLIC = "ба бе би бо да де ди до га ге ги го ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то ва ве ви во".split()
GROW = 6


def _kind(value: Column) -> Column:
    """The kind of a match, told from its form; a name is taken apart later."""
    starts = lambda p: value.rlike(f"^(?:{p})$")
    return (F.when(value.contains("@"), "email").when(starts(IP), "ip").when(starts(ACCOUNT), "account").when(starts(SOCIAL), "social")
            .when(starts(CARD), "card").when(value.rlike(r"^[+(\d]"), "phone").otherwise("name"))


def entities(text: Column) -> Column:
    """array<struct<start, end, kind, value>> of a text, from left to right; names give a part for each of their words."""
    plain = F.when(text.rlike(HINT), match_spans(text, ENTITY, 0)).otherwise(F.array().cast(SPAN))
    span = lambda start, end, kind, value: F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), kind.alias("kind"), value.alias("value"))

    def parts(x):
        title = F.regexp_extract(x["value"], r"^(\S+?)\.? ", 1)
        words = F.split(x["value"], " ")
        first, last = F.element_at(words, 2), F.element_at(words, -1)
        gender = F.when(title.isin(*FEMALE), "given_f").otherwise("given_m")
        given_at = x["start"] + F.length(F.element_at(words, 1)) + 1
        surname = span(x["end"] - F.length(last), x["end"], F.lit("surname"), last)
        named = F.when(F.size(words) > 2, F.array(span(given_at, given_at + F.length(first), gender, first), surname)).otherwise(F.array(surname))
        return F.when(_kind(x["value"]) == "name", named).otherwise(F.array(span(x["start"], x["end"], _kind(x["value"]), x["value"])))

    return F.flatten(F.transform(plain, parts))


def mentions(rows: DataFrame, each: DataFrame, text: Column) -> DataFrame:
    """Further mentions, like ``each``, of the names found in a row: capitalised words outside the spans found."""
    named = F.col("kind").isin("given_f", "given_m", "surname")
    names = each.where(named).groupBy("row", "norm").agg(F.max("kind").alias("kind"))  # a surname before a given name
    with_names = rows.where(F.exists("found", lambda x: x["kind"].isin("given_f", "given_m", "surname")))
    words = with_names.select("row", F.explode(match_spans(text, MENTION, 0)).alias("e")).select("row", F.col("e.start").alias("start"), F.col("e.end").alias("end"), F.col("e.value").alias("value"))
    words = words.withColumn("norm", F.lower("value")).join(names, ["row", "norm"]).select("row", "start", "end", "kind", "value", "norm")
    # a word is free if no span found before it reaches into it and none starts within it
    all_ = words.withColumn("word", F.lit(True)).unionByName(each.select("row", "start", "end", "kind", "value", "norm", F.lit(False).alias("word")))
    line, back = Window.partitionBy("row").orderBy("start"), Window.partitionBy("row").orderBy(F.col("start").desc())
    into = F.max(F.when(~F.col("word"), F.col("end"))).over(line.rangeBetween(Window.unboundedPreceding, 0))
    within = F.min(F.when(~F.col("word"), F.col("start"))).over(back.rangeBetween(Window.unboundedPreceding, 0))
    free = F.coalesce(into <= F.col("start"), F.lit(True)) & F.coalesce(within >= F.col("end"), F.lit(True))
    return all_.withColumn("free", free).where("word and free").drop("word", "free")


def normal(kind: Column, value: Column) -> Column:
    """What all mentions of an entity have in common."""
    return F.when(kind.isin("card", "phone", "social"), F.regexp_replace(value, r"[^\d+]", "")).when(kind == "account", F.regexp_replace(value, " ", "")).otherwise(F.lower(value))


def _digits(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: c.cast("int"))


def check_digit(head: Column) -> Column:
    """The digit that makes a card number valid behind ``head``."""
    def add(total, d, i):
        doubled = d * 2
        return total + F.when(F.pmod(i, F.lit(2)) == 0, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(d)

    places = F.transform(F.reverse(_digits(head)), lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    total = F.aggregate(places, F.lit(0), lambda acc, x: add(acc, x["d"], x["i"]).cast("int"))
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10))


def _drawn(seed: Column, i: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, i), F.lit(n)).cast("int")


def _like(value: Column, seed: Column, keep: Column | None = None) -> Column:
    """Digit for digit and letter for letter; the first ``keep`` signs stay."""
    def sign(c, i):
        digit, low = _drawn(seed, i, 10).cast("string"), F.chr((_drawn(seed, i, 26) + 97).cast("bigint"))
        new = F.when(c.rlike("[0-9]"), digit).when(c.rlike("[a-z]"), low).when(c.rlike("[A-Z]"), F.upper(low)).when(c.rlike(r"\p{L}"), low).otherwise(c)
        return new if keep is None else F.when(i < keep, c).otherwise(new)

    return F.array_join(F.transform(F.split(value, ""), sign), "")


def surrogate(kind: Column, norm: Column, attempt: Column, key: Column) -> Column:
    """The surrogate of an entity in its normal form, drawn by a keyed hash."""
    seed = F.sha2(F.concat_ws(":", key, kind, norm, attempt.cast("string")), 256)
    grown = F.greatest(F.lit(0), attempt - GROW + 1)
    tail = F.when(grown > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(grown, F.lit(1))), lambda i: _drawn(seed, i + 1000, 10).cast("string")), "")).otherwise(F.lit(""))

    label = F.concat(F.lit("."), F.substring_index(norm, ".", -1))
    email = F.concat(_like(F.substr(norm, F.lit(1), F.length(norm) - F.length(label)), seed), tail, label)
    ip = F.concat_ws(".", *[(_drawn(seed, F.lit(i), 254) + 1).cast("string") for i in range(4)])
    body = F.substr(norm, F.lit(1), F.length(norm) - 1)
    head = F.concat(_like(body, seed, F.lit(1)), tail)
    valid = check_digit(body).cast("string") == F.right(norm, F.lit(1))
    card = F.concat(head, F.when(valid, check_digit(head).cast("string")).otherwise(_drawn(seed, F.lit(99), 10).cast("string")))
    phone = F.concat(_like(norm, seed, F.when(norm.startswith("+"), F.greatest(F.lit(2), F.length(norm) - 10)).otherwise(F.lit(0))), tail)
    account = F.concat(_like(norm, seed, F.lit(2)), tail)

    cyrillic = norm.rlike(r"\p{IsCyrillic}")
    table = lambda s: F.array(*[F.lit(x) for x in s])
    syllable = lambda i: F.when(cyrillic, F.element_at(table(CYRILLIC), _drawn(seed, i, len(CYRILLIC)) + 1)).otherwise(F.element_at(table(LATIN), _drawn(seed, i, len(LATIN)) + 1))
    many = F.when(kind == "surname", F.lit(3)).otherwise(F.lit(2)) + F.floor(attempt / 2).cast("int")
    stem = F.array_join(F.transform(F.sequence(F.lit(1), many), syllable), "")
    end = (F.when(kind == "given_f", F.when(cyrillic, "на").otherwise("na")).when(kind == "given_m", F.when(cyrillic, "н").otherwise("n"))
           .otherwise(F.when(cyrillic, "р").otherwise("r")))
    name = F.concat(stem, end)
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone)
            .when(kind == "social", F.concat(_like(norm, seed), tail)).when(kind == "account", account).otherwise(name))


def assigned(found: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) of each distinct entity; surrogates of a kind are distinct and no entity of it.

    Rounds: entities without surrogate draw; a draw counts if it is taken by
    none before, is no entity itself, and its entity is the least of those that
    drew it.
    """
    known = staged(found.select("kind", "norm").distinct(), "entities")
    taken, open_, attempt = None, known, 0
    while attempt == 0 or not open_.isEmpty():
        drawn = staged(open_.withColumn("surrogate", surrogate(F.col("kind"), F.col("norm"), F.lit(attempt), F.lit(key))), "drawn")
        fresh = drawn.join(known.select("kind", F.col("norm").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if taken is not None:
            fresh = fresh.join(taken.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = staged(fresh.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm")).select("kind", "norm", "surrogate"), "won")
        taken = won if taken is None else staged(taken.unionByName(won), "taken")
        open_ = staged(open_.join(won.select("kind", "norm"), ["kind", "norm"], "left_anti"), "open")
        attempt += 1
    return taken


def fitted(kind: Column, value: Column, new: Column) -> Column:
    """The surrogate in the form of a mention: its separators, or its case."""
    def lay(acc, c):
        sign = F.when(c.rlike("[A-Za-z0-9]"), F.substr(new_signs, acc["k"], F.lit(1))).otherwise(c)
        return F.struct((acc["k"] + c.rlike("[A-Za-z0-9]").cast("int")).alias("k"), F.concat(acc["out"], sign).alias("out"))

    new_signs = F.regexp_replace(new, r"[^A-Za-z0-9]", "")
    laid = F.aggregate(F.split(value, ""), F.struct(F.lit(1).alias("k"), F.lit("").alias("out")), lay, lambda acc: F.concat(acc["out"], F.substr(new_signs, acc["k"])))
    cased = F.when(value == F.upper(value), F.upper(new)).when(kind.isin("given_f", "given_m", "surname"), F.initcap(new)).otherwise(new)
    return F.when(kind.isin("card", "phone", "social", "account"), laid).otherwise(cased)


def replaced(docs: DataFrame, key: str = "surrogates", text_col: str = "text") -> DataFrame:
    """The documents with surrogates in their text, and ``replacements``: array<struct<start, end, kind, new>>.

    Texts with entities are joined to their surrogates; the others never move.
    """
    names = docs.columns
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
                              entities(F.coalesce(F.col(text_col), F.lit(""))).alias("found")), "entity-rows")
    each = rows.select("row", F.explode("found").alias("e")).select("row", "e.*").withColumn("norm", normal(F.col("kind"), F.col("value")))
    every = each.unionByName(mentions(rows, each, F.col(f"doc.`{text_col}`")))
    new = every.join(assigned(each, key), ["kind", "norm"])
    new = new.select("row", "start", "end", "kind", fitted(F.col("kind"), F.col("value"), F.col("surrogate")).alias("new"))
    per = new.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "new"))).alias("spans"))
    text = F.col(f"doc.`{text_col}`")
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,new:string>>")
    others = F.struct(*[F.col(f"doc.`{c}`").alias(c) for c in names if c != text_col], F.lit(0).alias("__"))
    clean = rows.where(F.size("found") == 0).select(text.alias("new_text"), others.alias("doc"), none.alias("spans"))
    dirty = rows.where(F.size("found") > 0)
    texts = rewritten(dirty.select("row", text.alias("text")), new.select("row", "start", "end", "new")).withColumnRenamed("text", "new_text")
    dirty = dirty.select("row", others.alias("doc")).join(per, "row").join(texts, "row").select("new_text", "doc", "spans")
    both = clean.unionByName(dirty)
    return both.select(*[F.col("new_text").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in names], F.col("spans").alias("replacements"))


def op5_surrogates(spark, folder):
    d = replaced(documents(spark, folder).select("doc_id", "text"))
    count = lambda *kinds: F.size(F.filter("replacements", lambda x: x["kind"].isin(*kinds))).cast("bigint")
    return d.select("doc_id", "text", F.size("replacements").cast("bigint").alias("n_replaced"), *[count(k).alias(f"n_{k}") for k in KINDS[:6]],
                    count(*KINDS[6:]).alias("n_name"))
