"""Text analysis as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glimmerdex.decisions import TOKEN_SEPARATOR

# Whitespace as Python's str.split() sees it.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
PIECE = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def tokens(text) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(col), TOKEN_SEPARATOR), "")


def folded_tokens(text) -> Column:
    """Tokens with accents folded away, the alternate analysis of a text field."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(fold_accents(F.lower(col)), TOKEN_SEPARATOR), "")


# Accented Latin letters and their plain forms, position by position.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def fold_accents(col: Column) -> Column:
    return F.translate(col, ACCENTED, PLAIN)


def query_clean(query) -> Column:
    """Braces and double quotes become spaces before keyword use."""
    col = F.col(query) if isinstance(query, str) else query
    return F.translate(col, '{}"', "   ")


def first_n_words(text, n: int) -> Column:
    """First n whitespace-separated words joined by one space; null gives ''."""
    col = F.col(text) if isinstance(text, str) else text
    words = F.array_remove(F.split(F.coalesce(col, F.lit("")), WHITESPACE), "")
    return F.array_join(F.slice(words, 1, n), " ")


def joined(col: Column, is_array: bool) -> Column:
    """Multi-valued text joined by a space; null gives ''."""
    text = F.array_join(col, " ") if is_array else col.cast("string")
    return F.coalesce(text, F.lit(""))


def highlight(text, terms, before: int = 10, width: int = 40, pre: str = "<em>", post: str = "</em>") -> Column:
    """A snippet around the first matching word with every matching word marked.

    The text is cut into words and the gaps between them, so marking follows
    the analyzer exactly. `before` and `width` count words and gaps.
    """
    text = F.col(text) if isinstance(text, str) else text
    terms = F.col(terms) if isinstance(terms, str) else terms
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    first = F.array_position(F.transform(pieces, lambda p: F.array_contains(terms, F.lower(p))), True)
    start = F.greatest(first.cast("int") - F.lit(before), F.lit(1))
    shown = F.slice(pieces, start, F.lit(width))
    marked = F.transform(
        shown,
        lambda p: F.when(F.array_contains(terms, F.lower(p)), F.concat(F.lit(pre), p, F.lit(post))).otherwise(p),
    )
    return F.array_join(marked, "")
