"""Matches of patterns with their places, as column expressions.

A place is a pair of code point offsets, the end exclusive. The patterns are written so
that the regular expression engine neither backtracks over long runs nor recurses per
repeated character: repetitions are possessive or step by single characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:bigint,end:bigint>"


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def found(text: Column, kind: str, pattern: str | Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """The spans of the leftmost matches that do not overlap, in order, of those that pass keep(match).

    Cutting the text at the matches gives what lies between them, and both lengths
    together give the places. The matches themselves are taken only where there are any.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps = F.split(text, pattern, -1)
    matches = F.when(F.size(gaps) > 1, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    pairs = F.transform(
        F.arrays_zip(gaps.alias("gap"), matches.alias("hit")),
        lambda p: F.struct(F.length(p["gap"]).cast("long").alias("gap"), p["hit"].alias("hit")),
    )
    placed = F.aggregate(
        F.filter(pairs, lambda p: p["hit"].isNotNull()),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,hit:string>>").alias("seen")),
        lambda done, p: F.struct(
            (done["at"] + p["gap"] + F.length(p["hit"])).alias("at"),
            F.concat(done["seen"], F.array(F.struct((done["at"] + p["gap"]).alias("start"), p["hit"].alias("hit")))).alias("seen"),
        ),
        lambda done: done["seen"],
    )
    kept = F.filter(placed, lambda m: keep(m["hit"])) if keep else placed
    spans = F.transform(
        kept,
        lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["hit"])).alias("end")),
    ).cast(f"array<{SPAN}>")
    return F.when(F.size(gaps) > 1, spans).otherwise(none())


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the upper-case kind of its first one."""
    ordered = F.array_sort(
        spans,
        lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
        .otherwise(F.signum(b["end"] - a["end"]))
        .cast("int"),
    )
    rest = lambda at, end: F.substr(text, (at + 1).cast("int"), F.greatest(end - at, F.lit(0)).cast("int"))
    return F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda done, s: F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= done["at"],
                F.concat(done["out"], rest(done["at"], s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")),
            )
            .otherwise(done["out"])
            .alias("out"),
        ),
        lambda done: F.concat(done["out"], rest(done["at"], F.length(text).cast("long"))),
    )
