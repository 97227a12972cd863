"""Total order and top-k per query."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glimmerdex.decisions import SCORE_DIGITS

SALTS = 64


def rounded(score: Column) -> Column:
    return F.round(score, SCORE_DIGITS)


def rank_order(score: str = "score", key: str = "doc_key") -> list[Column]:
    """Rounded score first, key as tie-break: the same rows come back on every run."""
    return [F.col(score).desc(), F.col(key)]


def top_k(
    df: DataFrame,
    k: int,
    by: tuple[str, ...] = ("query_id",),
    order: list[Column] | None = None,
    spread_by: str = "doc_key",
    rank: str = "rank",
) -> DataFrame:
    """The best k rows per group, numbered from 1.

    Up to the window-group-limit threshold Spark keeps only k rows per group and
    task before the shuffle, so a hot group never travels whole. Beyond it the
    group is first cut in salted parts, each ranked by itself.
    """
    order = order or rank_order()
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        salt = F.pmod(F.xxhash64(spread_by), F.lit(SALTS))
        part = Window.partitionBy(*by, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_part_rank", F.row_number().over(part))
            .filter(F.col("_part_rank") <= k)
            .drop("_salt", "_part_rank")
        )
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def most_rows(queries: DataFrame, k: int) -> int:
    """The greatest number of result rows, from the number of queries."""
    return queries.count() * k


def without_score(hits: DataFrame) -> DataFrame:
    """The same result rows with scores dropped."""
    return hits.drop("score")


def retriever(search, **options):
    """A search function with stored options; the result carries no scores."""
    preset = partial(search, **options)
    return lambda *args, **kwargs: without_score(preset(*args, **kwargs))
