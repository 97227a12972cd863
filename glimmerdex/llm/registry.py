"""Registration of this subpackage's queries, and the helpers its operators share."""

from __future__ import annotations

import gc
import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from glimmerdex.plans.sizing import in_small_batches  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows where SQL can say it."""

    def keep(function: Query) -> Query:
        QUERIES[key] = function
        if sql is not None:
            CHECKS[key] = sql
        return function

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


_HOLDER: list[tuple[str, Callable[[], None] | None]] = []


def take_over(name: str, release: Callable[[], None] | None = None) -> None:
    """Called by a task in its worker process, which may have served another operator: what that one kept is released.

    `release` frees what the caller itself keeps from task to task."""
    if _HOLDER and _HOLDER[0][0] != name:
        _, let_go = _HOLDER.pop()
        if let_go:
            let_go()
        give_back()
    if not _HOLDER:
        _HOLDER.append((name, release))


def give_back() -> None:
    """Return this process's freed memory to the machine, which the next operator's worker shares with the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def free_name(df: DataFrame, wanted: str) -> str:
    """The wanted column name, lengthened until the table has no such column in any letter case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names; whatever else the table holds stays out of the way."""
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in columns.items()])
