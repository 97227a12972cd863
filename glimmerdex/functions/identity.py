"""Document identity: one URI per document, its md5 is the key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glimmerdex.decisions import DEFAULT_BASE_URI


def percent_encode(col: Column) -> Column:
    """RFC 3986 percent-encoding with nothing but unreserved characters kept."""
    form = F.url_encode(col)
    for coded, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        form = F.replace(form, F.lit(coded), F.lit(plain))
    return form


def document_uri(
    doc_id: Column, uri: Column, url: Column, index: str | Column, base_uri: str = DEFAULT_BASE_URI
) -> Column:
    """The given web address, else one made from base, index (a name, or a column of names) and id; no trailing slash."""
    given = F.coalesce(F.nullif(uri, F.lit("")), F.nullif(url, F.lit("")))
    is_web = given.startswith("http://") | given.startswith("https://")
    folder = F.concat(F.lit(f"{base_uri}/"), index, F.lit("/")) if isinstance(index, Column) else F.lit(f"{base_uri}/{index}/")
    made = F.concat(folder, percent_encode(doc_id))
    return F.rtrim(F.when(is_web, given).otherwise(made), F.lit("/"))


def document_key(uri: Column) -> Column:
    return F.md5(uri)
