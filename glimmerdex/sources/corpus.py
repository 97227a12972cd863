"""Input tables: text corpora and web pages."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The standard's named character references, as far as they end in a semicolon.
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"
DROPPED_ELEMENTS = ("head", "script", "style", "nav", "noscript", "template")


def corpus_scan(spark: SparkSession, path: str, id_col: str, text_col: str, metadata_cols: list[str] | None = None, format: str = "parquet") -> DataFrame:
    """(id, text, metadata…) from any file source Spark reads."""
    source = spark.read.format(format).load(path)
    kept = metadata_cols if metadata_cols is not None else [c for c in source.columns if c not in (id_col, text_col)]
    return source.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), *[F.col(c) for c in kept]
    )


def corpus_from_texts(
    spark: SparkSession, texts: list[str], metadatas: list[str] | None = None, ids: list[str] | None = None
) -> DataFrame:
    """A small corpus given as parallel lists; metadata are JSON strings, ids default to random ones."""
    metadatas = metadatas or ["{}"] * len(texts)
    if len(texts) != len(metadatas) or (ids is not None and len(ids) != len(texts)):
        raise ValueError(f"{len(texts)} texts come with {len(metadatas)} metadata and {len(texts if ids is None else ids)} ids")
    rows = [(t, m, i) for i, (t, m) in enumerate(zip(texts, metadatas))]
    if ids is None:
        return spark.createDataFrame(rows, "text string, metadata string, seq long")
    return spark.createDataFrame(
        [(*row, str(i)) for row, i in zip(rows, ids)], "text string, metadata string, seq long, id string"
    )


def _referred(reference: Column) -> Column:
    """What one reference stands for: a character by number, a standard name, or itself."""
    named = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")
    name = F.substr(reference, F.lit(2), F.length(reference) - 2)
    number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2))).cast("int")
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return F.when(name.startswith("#"), character).otherwise(F.coalesce(F.element_at(named, name), reference))


def unescape(col: Column) -> Column:
    """Every character reference resolved once, from left to right."""
    gaps = F.split(col, REFERENCE, -1)
    resolved = F.transform(F.regexp_extract_all(col, F.lit(REFERENCE), F.lit(0)), _referred)
    joined = F.array_join(F.transform(F.arrays_zip(gaps.alias("g"), resolved.alias("r")), lambda p: F.concat(p["g"], F.coalesce(p["r"], F.lit("")))), "")
    return F.when(col.contains("&"), joined).otherwise(col)


def single_spaced(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, r"[\s\x{A0}]+", " "))


def plain_text(html: Column) -> Column:
    """Markup, scripts, styles, navigation and comments go; character references are resolved."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for name in DROPPED_ELEMENTS:
        text = F.regexp_replace(text, rf"(?is)<{name}(\s[^>]*)?>.*?</{name}\s*>", " ")
    return single_spaced(unescape(F.regexp_replace(text, r"<[^>]*>", " ")))


def page_source(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, uri, title, description, text) from raw pages; the address is the identity."""
    html = F.col(html_col)
    title = F.regexp_extract(html, r"(?is)<title(\s[^>]*)?>(.*?)</title\s*>", 2)
    # The attributes may come in any order, with either kind of quotes.
    meta = F.regexp_extract(html, r"(?is)<meta\s(?=[^>]*\bname\s*=\s*(?:\"description\"|'description'|description\b))(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", 0)
    quoted = F.regexp_extract(meta, r"(?is)\bcontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", 1)
    description = F.concat(quoted, F.regexp_extract(meta, r"(?is)\bcontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", 2))
    return pages.select(
        F.col(url_col).alias("id"),
        F.col(url_col).alias("uri"),
        single_spaced(unescape(title)).alias("title"),
        single_spaced(unescape(description)).alias("description"),
        plain_text(html).alias("text"),
    )
