"""Personal data: patterns, and terms that give it away (operator 7).

Patterns find e-mail and IP addresses, card and phone numbers; those values are the
protected entities. Corpus co-occurrence then says how strongly a term reveals one: with
probabilities estimated over the distinct texts of the whole corpus, the share of an
entity's information that a term carries is

    log2(N * n(entity, term) / (n(entity) * n(term))) / log2(N / n(entity))

where n(entity, term) counts texts that have the term within WINDOW characters of the
entity. It is 1 when the term occurs nowhere else. Terms at GENERALISE or more are
replaced by a class label, those at REMOVE or more are removed, wherever they occur: a
text without the entity is where they would give it away. Copies must not pass for evidence: counts are over distinct texts, and
a term needs SUPPORT different neighbourhoods with the entity.

Defined results: a null text counts as empty and has no spans; repeated rows give
repeated results; an empty table gives an empty one. Other columns are kept by
`sanitise` as they are. Everything is column expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex.llm import spans as S
from glimmerdex.llm.registry import free_name, pick, query, table
from glimmerdex.plans.sizing import keyed_join, written

KINDS = ("email", "ip", "card", "phone")
WINDOW = 80
SUPPORT = 3
GENERALISE = 0.8
FIRST_PART = 16  # common terms are ruled out by counting one text in so many first
REMOVE = 0.95

EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?=\.[A-Za-z0-9-])"
    r"(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
SMALL = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])?"  # a part of zeros is taken whole before the group
CARD = r"[0-9](?:(?![ -](?![0-9]))[0-9 -]){15,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    place = F.sequence(F.lit(1), F.length(number))
    total = F.aggregate(
        F.transform(place, lambda i: F.struct(i.alias("i"), F.substr(number, F.length(number) - i + 1, F.lit(1)).cast("int").alias("d"))),
        F.lit(0),
        lambda s, p: s + F.when(p["i"] % 2 == 1, p["d"]).when(p["d"] > 4, 2 * p["d"] - 9).otherwise(2 * p["d"]),
    )
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans by kind as listed, then by start."""
    held = lambda low, high: lambda m: F.length(digits(m)).between(low, high)
    return F.concat(
        F.when(F.contains(text, F.lit("@")), S.found(text, "email", EMAIL)).otherwise(S.none()),
        S.found(text, "ip", IP, lambda m: m.rlike(rf"^{SMALL}\.{SMALL}\.{SMALL}\.{SMALL}$")),
        S.found(text, "card", CARD, lambda m: held(16, 19)(m) & luhn(digits(m))),
        F.when(F.contains(text, F.lit("+")), S.found(text, "phone", PHONE, held(8, 15))).otherwise(S.none()),
    )


def words(text: Column) -> Column:
    """The runs of letters and digits, as written."""
    return F.filter(F.split(text, r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def mentions(docs: DataFrame) -> DataFrame:
    """(kind, value, text_hash, context, terms): every protected value with the words around it.

    The words cut by the border of the neighbourhood are left out."""
    held = docs.withColumn("span", F.explode(base_spans(F.col("text"))))
    start, end = F.col("span.start"), F.col("span.end")
    low = F.greatest(start - WINDOW, F.lit(0))
    before = F.substr("text", (low + 1).cast("int"), (start - low).cast("int"))
    before = F.when(low > 0, F.regexp_replace(before, r"^[\p{L}\p{N}]+", "")).otherwise(before)
    after = F.substr("text", (end + 1).cast("int"), F.lit(WINDOW))
    after = F.when(end + WINDOW < F.length("text"), F.regexp_replace(after, r"[\p{L}\p{N}]+$", "")).otherwise(after)
    around = F.concat_ws(" ", before, after)
    return held.select(
        F.col("span.kind").alias("kind"),
        F.substr("text", (start + 1).cast("int"), (end - start).cast("int")).alias("value"),
        "text_hash",
        F.xxhash64(around).alias("context"),
        F.array_distinct(F.transform(words(around), F.lower)).alias("terms"),
    )


def disclosing(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """(text_hash, form, share) of the terms that reveal a protected value, as written in every text of the corpus that holds them.

    The share of a term is its greatest with any value."""
    entity = ["kind", "value"]
    pairs = seen.select(*entity, "text_hash", "context", F.explode("terms").alias("term"))
    support = pairs.select(*entity, "term", "context").distinct().groupBy(*entity, "term").agg(F.count("*").alias("contexts"))
    joint = pairs.select(*entity, "term", "text_hash").distinct().groupBy(*entity, "term").agg(F.count("*").alias("joint"))
    alone = seen.select(*entity, "text_hash").distinct().groupBy(*entity).agg(F.count("*").alias("texts"))
    total = docs.select("text_hash").distinct().count()
    # a term already seen beside protected values in too many texts cannot reach GENERALISE, whatever the rest holds
    beside = pairs.select("term", "text_hash").distinct().groupBy("term").agg(F.count("*").alias("least"))
    most = F.col("joint") * F.pow(F.lit(float(total)) / F.col("texts"), F.lit(1.0 - GENERALISE)) + 1e-6
    likely = written(
        support.filter(F.col("contexts") >= SUPPORT)
        .join(joint, [*entity, "term"])
        .join(alone, entity)
        .join(beside, "term")
        .filter((F.col("texts") < total) & (F.col("least") <= most)),
        "likely-terms",
    )

    def held_by(texts: DataFrame, wanted: DataFrame) -> DataFrame:
        """(term, form, text_hash): the different texts in which each wanted term occurs, and how it is written there."""
        met = texts.select("text_hash", F.explode(F.array_distinct(words(F.col("text")))).alias("form"))
        return keyed_join(met.withColumn("term", F.lower("form")), wanted, ["term"], "text_hash").distinct()

    def numbered(met: DataFrame) -> DataFrame:
        """(term, held): in how many different texts each term occurs, in whatever form."""
        return met.select("term", "text_hash").distinct().groupBy("term").agg(F.count("*").alias("held"))

    # What a part of the texts holds is a lower bound for all: terms that it rules out need no count over the rest.
    bound = likely.groupBy("term").agg(F.max(most).alias("most"))
    part = numbered(held_by(docs.filter(F.pmod("text_hash", F.lit(FIRST_PART)) == 0), bound.select("term")))
    wanted = bound.join(part, "term", "left").filter(F.coalesce("held", F.lit(0)) <= F.col("most")).select("term")
    met = written(held_by(docs, written(wanted, "wanted-terms")), "met-terms")
    share = F.log2(F.lit(float(total)) * F.col("joint") / (F.col("texts") * F.col("held"))) / F.log2(
        F.lit(float(total)) / F.col("texts")
    )
    telling = (
        likely.join(numbered(met), "term")
        .withColumn("share", share)
        .filter(F.col("share") >= GENERALISE)
        .groupBy("term")
        .agg(F.max("share").alias("share"))
    )
    return keyed_join(met, written(telling, "disclosing"), ["term"], "text_hash").select("text_hash", "form", "share")


def spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The table with `pii_base` and `pii_spans` (base spans and terms) added, each an array of kind, start and end."""
    base, every = free_name(docs, "pii_base"), free_name(docs, "pii_spans")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    hashed = free_name(docs, "text_hash")
    corpus = pick(docs, text=text_col).select(F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    seen = written(mentions(corpus).distinct(), "mentions")
    per_text = (
        disclosing(corpus, seen)
        .groupBy("text_hash")
        .agg(
            F.array_sort(F.collect_set(F.when(F.col("share") < REMOVE, F.col("form")))).alias("_general"),
            F.array_sort(F.collect_set(F.when(F.col("share") >= REMOVE, F.col("form")))).alias("_removed"),
        )
        .withColumnRenamed("text_hash", hashed)
    )
    joined = keyed_join(docs.withColumn(hashed, F.xxhash64(text)), written(per_text, "telling-texts"), [hashed], hashed, "left")

    def terms(kind: str, column: str) -> Column:
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(column, "|"), F.lit(r")(?![\p{L}\p{N}])"))
        clear = lambda t: ~F.exists(F.col(base), lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"]))
        return F.when(F.size(column) > 0, F.filter(S.found(text, kind, pattern), clear)).otherwise(S.none())

    return (
        joined.withColumn(base, base_spans(text))
        .withColumn(every, F.concat(base, terms("term", "_general"), terms("removed", "_removed")))
        .drop(hashed, "_general", "_removed")
    )


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The table with personal data and disclosing terms in the text replaced by labels; clean texts stay as they are."""
    every = free_name(docs, "pii_spans")
    marked = spans(docs, text_col)
    text = F.col(f"`{text_col}`")
    return marked.withColumn(text_col, F.when(F.size(every) > 0, S.replaced(text, F.col(every))).otherwise(text)).select(
        *[f"`{c}`" for c in docs.columns]
    )


@query("op7_pii")
def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    marked = spans(pick(table(spark, sf, "documents"), doc_id="doc_id", text="text"))
    return marked.select(
        "doc_id",
        *[S.count_of(F.col("pii_base"), kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(S.listed(F.col("pii_base")), 256).alias("base_sha256"),
        S.listed(F.col("pii_spans")).alias("spans"),
    )
