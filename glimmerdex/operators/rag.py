"""Context and prompt rows for a language model the user brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex import decisions as D
from glimmerdex.functions.text import first_n_words, joined
from glimmerdex.operators.shaping import attach_documents

GROUNDED_BEFORE = "Using nothing but the context, give a short and factual answer to the question: '"
GROUNDED_AFTER = "'. Say so when the context does not hold the answer, and name the titles you relied on."


def rag_context(
    hits: DataFrame, documents: DataFrame, docs: int | None = None, words: int | None = None, n_queries: int | None = None
) -> DataFrame:
    """(query_id, context): the top hits in rank order, one after the other.

    Each part is 'title - description - first words of text - '. Zero or None
    mean the defaults. A group holds at most `docs` rows. `n_queries` bounds the
    result rows, which are then broadcast to the documents.
    """
    docs = docs or D.RAG_DOCS
    words = words or D.RAG_WORDS
    top = hits.filter(F.col("rank") <= docs).select("query_id", "rank", "doc_key")
    at_most = None if n_queries is None else n_queries * docs
    rows = attach_documents(top, documents, ["title", "description", "text"], at_most)

    def value(name: str) -> Column:
        return joined(F.col(name), isinstance(rows.schema[name].dataType, T.ArrayType))

    part = F.concat(
        value("title"), F.lit(" - "), value("description"), F.lit(" - "),
        first_n_words(value("text"), words), F.lit(" - "),
    )
    parts = F.sort_array(F.collect_list(F.struct("rank", part.alias("part"))))
    return rows.groupBy("query_id").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("context"))


def grounded_instruction(query: Column) -> Column:
    return F.concat(F.lit(GROUNDED_BEFORE), query, F.lit(GROUNDED_AFTER))


def rag_prompt(queries: DataFrame, contexts: DataFrame, instruction: str | None = None) -> DataFrame:
    """(query_id, query_text, instruction, context): one prompt row per query.

    The caller's instruction wins; the built-in one is used only with a context
    built here. A `context` column in `queries` is the caller's own context and
    skips retrieval. An empty context is left out.
    """
    own = F.col("context") if "context" in queries.columns else F.lit(None).cast("string")
    asked = queries.select("query_id", "query_text", own.alias("_own"))
    rows = asked.join(contexts.withColumnRenamed("context", "_built"), "query_id", "left")
    built = F.when(F.col("_own").isNull(), F.nullif(F.col("_built"), F.lit("")))
    default = F.when(built.isNotNull(), grounded_instruction(F.col("query_text")))
    return rows.select(
        "query_id",
        "query_text",
        (F.lit(instruction) if instruction else default).alias("instruction"),
        F.coalesce(F.col("_own"), built).alias("context"),
    )


def answer(prompts: DataFrame, model: Callable[[list[dict]], list[str]], batch: int = D.EMBED_BATCH) -> DataFrame:
    """Prompt rows plus an `answer` column from the user's callable, trimmed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for frame in batches:
            rows = frame.astype(object).where(frame.notna(), None).to_dict("records")
            replies: list[str] = []
            for start in range(0, len(rows), batch):
                chunk = rows[start : start + batch]
                reply = list(model(chunk))
                if len(reply) != len(chunk):
                    raise ValueError(f"model returned {len(reply)} answers for {len(chunk)} prompts")
                replies += [None if r is None else r.strip() for r in reply]
            yield pd.Series(replies, dtype=object)

    udf = F.pandas_udf(run, "string")
    return prompts.withColumn("answer", udf(F.struct("query_id", "query_text", "instruction", "context")))
