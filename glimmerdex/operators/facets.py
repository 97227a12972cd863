"""Counts per field value over a match set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmerdex.functions.metadata import sanitize_name
from glimmerdex.operators.ranking import top_k


def facet_counts(matches: DataFrame, fields: list[str], top: int | None = None, meta: str = "meta") -> DataFrame:
    """(field, value, count), most frequent first, all fields in one pass.

    Fields are real columns where they exist, metadata fields otherwise. Counting
    is partial before the shuffle, so a dominant value costs one row per task.
    """
    names = [(f, f if f in matches.columns else None) for f in fields]
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("field"),
                    (F.col(f"`{c}`").cast("string") if c else F.col(meta)[sanitize_name(f)]).alias("value"),
                )
                for f, c in names
            ]
        )
    )
    counts = (
        matches.select(pairs.alias("p"))
        .select("p.field", "p.value")
        .filter(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if top is None:
        return counts
    order = [F.col("count").desc(), F.col("value")]
    return top_k(counts, top, by=("field",), order=order, spread_by="value", rank="position")
