"""Language and sentiment per document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmerdex.functions.text import tokens
from glimmerdex.plans.sizing import keyed_join

# Frequent function words per language.
STOP_WORDS = {
    "de": "aber als am an auch auf aus bei bin das dem den der des die du ein eine einen einer er es für ich im in ist kein man mein mit nicht noch nur oder sich sie sind so und vom von war was wir wird zu zum zur",
    "en": "a all an and are as at be but by for from had has have he her his i in is it not of on or she that the their there they this to was we were what when which who will with you",
    "es": "a al ante con de del donde el ella en entre era es esta este fue ha hasta la las lo los más muy no nos o para pero por que se sin sobre son su sus te un una y ya",
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais me ne nous on ou par pas pour qu que qui sa se ses son sont sur tu un une vous à été",
}


def language(documents: DataFrame, profiles: dict[str, str] | None = None, text_col: str = "text", out: str = "language") -> DataFrame:
    """The language whose function words occur most; null when none do.

    Ties go to the first language by name. The count is made inside the row.
    """
    profiles = profiles or STOP_WORDS
    names = sorted(profiles)
    barrier = documents.select("*", F.stack(F.lit(1), tokens(text_col)).alias("_words"))

    def matching(words: list[str]):
        return F.size(F.filter("_words", lambda t: t.isin(*words)))

    counts = [matching(profiles[n].split()) for n in names]
    scored = barrier.withColumn("_counts", F.array(*counts))
    best = F.array_max("_counts")
    found = F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("_counts", best).cast("int"))
    return scored.withColumn(out, F.when(best > 0, found)).drop("_words", "_counts")


def sentiment(documents: DataFrame, lexicon: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_key, sentiment): mean weight of the words found in the caller's (term, weight) table.

    Null when no word is found. Each document leaves its task as one partial row.
    """
    words = documents.select("doc_key", F.explode_outer(tokens(text_col)).alias("term"))
    known = lexicon.select("term", F.col("weight").cast("double").alias("weight"))
    return keyed_join(words, known, ["term"], "doc_key", "left").groupBy("doc_key").agg(F.avg("weight").alias("sentiment"))
