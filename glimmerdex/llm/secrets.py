"""Secret scans over an incremental blob ledger (operator 8).

A blob is a text addressed by its SHA-256. The ledger is a folder of Parquet rows
(blob, rule, version, spans), one for every scan made, with or without findings. A scan
takes the blobs whose pair with a rule's current version is not in the ledger, scans
each distinct one once, appends the rows, and joins the findings back to every path that
holds the blob. A new version of a rule makes its pairs unseen again; rows of older
versions stay.

Defined results: a null text is the empty blob; repeated rows and paths give repeated
results; null paths are kept; an empty table gives an empty result and an empty ledger.
Other columns are not read. Everything is column expressions and joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmerdex.llm import spans as S
from glimmerdex.llm.registry import pick, query, table
from glimmerdex.plans.sizing import keyed_join, scratch_path, written


@dataclass(frozen=True)
class Rule:
    name: str
    version: int
    pattern: str
    keep: Callable[[Column], Column] | None = None


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    Rule("assign", 1, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 8),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}+"),
    Rule("hex", 1, "[0-9a-f]{32,}+"),
)
LEDGER = f"blob string, rule string, version int, spans array<{S.SPAN}>"


def empty_ledger(spark: SparkSession, folder: str) -> None:
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(folder)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(folder)


def blobs(docs: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """path, blob and text of every row."""
    rows = pick(docs, path=path_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))


def unseen(rows: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per distinct blob that some rule has not scanned in its current version: blob, text, missing rules."""
    current = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.version)])
    names = F.array(*[F.lit(r.name) for r in rules])
    done = (
        ledger.filter(current[F.col("rule")] == F.col("version"))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("done"))  # at most one entry per rule
    )
    left = keyed_join(rows, done, ["blob"], "path", "left").withColumn(
        "missing", F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
    )
    first = Window.partitionBy("blob").orderBy("path")  # cut to one row per blob and task before the shuffle
    return (
        left.filter(F.size("missing") > 0)
        .withColumn("nth", F.row_number().over(first))
        .filter("nth = 1")
        .select("blob", "text", "missing")
    )


def scan(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """path and spans (kind, start, end; by start, then rule as listed) of every row; the ledger in the folder grows."""
    spark = docs.sparkSession
    rows = blobs(docs, path_col, text_col)
    results = [
        F.when(
            F.array_contains("missing", r.name),
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.version).alias("version"),
                S.found(F.col("text"), r.name, r.pattern, r.keep).alias("spans"),
            ),
        )
        for r in rules
    ]
    empty_ledger(spark, folder)
    scanned = unseen(rows, read_ledger(spark, folder), rules).select("blob", F.array_compact(F.array(*results)).alias("results"))
    fresh = written(scanned, "scanned").select("blob", F.explode("results").alias("r"))
    fresh.select("blob", "r.rule", "r.version", "r.spans").write.mode("append").parquet(folder)
    return findings(rows.select("path", "blob"), read_ledger(spark, folder), rules)


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path and spans of every row of (path, blob), from what the ledger knows by the current versions."""
    current = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.version)])
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    known = (
        ledger.filter((current[F.col("rule")] == F.col("version")) & (F.size("spans") > 0))
        .dropDuplicates(["blob", "rule"])
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))  # at most one list per rule
        .withColumn("spans", F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], place[s["kind"]].alias("rule"), s["kind"], s["end"]))))
        .withColumn("spans", F.transform("spans", lambda s: F.struct(s["kind"], s["start"], s["end"])))
    )
    joined = keyed_join(paths, known, ["blob"], "path", "left")
    return joined.select("path", F.coalesce("spans", S.none()).alias("spans"))


def _sql() -> str:
    """The same in SQL: places from the lengths of matches and of what lies between them."""
    assign = r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = {
        "assign": (assign, f"length(regexp_extract(m, '{assign}', 2)) >= 8"),
        "access": ("AKIA[A-Z0-9]{12,}", "true"),
        "hex": ("[0-9a-f]{32,}", "true"),
    }
    parts = " UNION ALL ".join(
        f"""SELECT n, '{kind}' AS kind, {place} AS place, m, s FROM (
        SELECT n, unnest(ms) AS m, unnest(list_transform(ms, lambda x, i: CAST(
          coalesce(list_sum(list_transform(gs[1:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(ms[1:i-1], lambda g: length(g))), 0) AS BIGINT))) AS s
        FROM (SELECT n, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d)) WHERE {keep}"""
        for place, (kind, (pattern, keep)) in enumerate(kinds.items())
    )
    count = lambda k: f"count(*) FILTER (kind = '{k}') AS n_{k}"
    return f"""WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({parts}),
g AS (SELECT n, {", ".join(map(count, kinds))}, string_agg(kind || ':' || s || ':' || (s + length(m)), ',' ORDER BY s, place) AS spans FROM f GROUP BY n)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds)}, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (n)"""


@query("op8_secrets", _sql())
def op8_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = scan(table(spark, sf, "documents"), scratch_path(spark, "op8-ledger"))
    spans = F.col("spans")
    return found.select(
        F.col("path").alias("doc_id"),
        *[S.count_of(spans, r.name).alias(f"n_{r.name}") for r in RULES],
        F.sha2(S.listed(spans), 256).alias("base_sha256"),
        S.listed(spans).alias("spans"),
    )
