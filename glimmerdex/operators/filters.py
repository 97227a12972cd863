"""Metadata filters as Column predicates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glimmerdex.functions.metadata import sanitize_name


def field(key: str, columns: dict[str, str] | None = None, meta: str = "meta") -> Column:
    """A metadata field as text.

    `columns` names fields that also exist as real columns: predicates on those
    reach the parquet scan, a look-up in the map does not.
    """
    name = sanitize_name(key)
    if columns and name in columns:
        return F.col(columns[name])
    return F.col(meta)[name]


def literal(value) -> Column:
    """A value rendered the way the write side renders it."""
    return F.lit(value).cast("string")


def equals(key: str, value, columns=None) -> Column:
    return field(key, columns) == literal(value)


def any_of(key: str, values: list, columns=None) -> Column:
    """Any of the values; no values match nothing."""
    return field(key, columns).isin(*[literal(v) for v in values]) if values else F.lit(False)


def between(key: str, low=None, high=None, columns=None) -> Column:
    """Closed numeric range on a text field, open where a bound is None."""
    number = field(key, columns).try_cast("double")
    bounds = [number.isNotNull()]
    if low is not None:
        bounds.append(number >= F.lit(float(low)))
    if high is not None:
        bounds.append(number <= F.lit(float(high)))
    return reduce(and_, bounds)


def to_column(filter, columns: dict[str, str] | None = None) -> Column | None:
    """None, a SQL predicate, a list of filters, or a dict of field values."""
    if filter is None:
        return None
    if isinstance(filter, Column):
        return filter
    if isinstance(filter, str):
        return F.expr(filter)
    if isinstance(filter, (list, tuple)):
        parts = [to_column(part, columns) for part in filter]
        parts = [p for p in parts if p is not None]
    elif isinstance(filter, dict):
        parts = [
            any_of(key, list(value), columns) if isinstance(value, (list, tuple)) else equals(key, value, columns)
            for key, value in filter.items()
        ]
    else:
        raise ValueError(f"cannot filter by a {type(filter).__name__}")
    return reduce(and_, parts) if parts else None


def apply(documents: DataFrame, filter, columns: dict[str, str] | None = None) -> DataFrame:
    predicate = to_column(filter, columns)
    return documents if predicate is None else documents.filter(predicate)


def min_score(hits: DataFrame, threshold: float) -> DataFrame:
    return hits.filter(F.col("score") >= F.lit(float(threshold)))
