"""Result rows: chosen fields, page content and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex.functions.text import joined
from glimmerdex.plans.sizing import broadcast_up_to


def field_list(rows: DataFrame, fields: str | list[str] = "*") -> DataFrame:
    """'*', '*,score', or names; unknown names are left out as a search result would."""
    names = [f.strip() for f in fields.split(",")] if isinstance(fields, str) else list(fields)
    wanted: list[str] = []
    for name in names:
        found = [c for c in rows.columns if c != "score"] if name == "*" else [name]
        wanted += [c for c in found if c in rows.columns and c not in wanted]
    return rows.select(*[F.col(f"`{c}`") for c in wanted])


def result_shape(rows: DataFrame, text_field: str = "text", fill_empty: bool = False) -> DataFrame:
    """Replace stored fields by `page_content` and `metadata`.

    Unreadable metadata falls back to the flattened fields. With `fill_empty`
    an empty object falls back as well and then shows the original id.
    """
    is_array = isinstance(rows.schema[text_field].dataType, T.ArrayType)
    parsed = F.from_json("meta_json", "map<string,string>")
    fallback = F.map_concat(
        F.map_filter("meta", lambda k, _: k != "ext_id"), F.create_map(F.lit("ext_id"), F.col("ext_id"))
    )
    usable = parsed.isNotNull() & ((F.size(parsed) > 0) if fill_empty else F.lit(True))
    return rows.withColumn("page_content", joined(F.col(text_field), is_array)).withColumn(
        "metadata", F.when(usable, parsed).otherwise(fallback)
    )


def attach_documents(hits: DataFrame, documents: DataFrame, fields: list[str], at_most: int | None = None) -> DataFrame:
    """Stored fields joined to the few result rows.

    Wide columns stay out of the ranking plans. `at_most` is the known greatest
    number of result rows; within bounds they are broadcast to the document scan,
    and the documents are not shuffled.
    """
    stored = documents.select("doc_key", *fields)
    return broadcast_up_to(hits, at_most).join(stored, "doc_key")


def shaped_results(
    hits: DataFrame, documents: DataFrame, text_field: str = "text", fill_empty: bool = False, at_most: int | None = None
) -> DataFrame:
    """(query_id, rank, doc_key, score, page_content, metadata)."""
    fields = list(dict.fromkeys([text_field, "meta", "meta_json", "ext_id"]))
    rows = result_shape(attach_documents(hits, documents, fields, at_most), text_field, fill_empty)
    kept = [c for c in hits.columns if c != "doc_key"]
    return rows.select("doc_key", *kept, "page_content", "metadata")
