"""The user's view of one index: add, delete, look up, search, prepare answers.

Searches take a string, a list of strings, or a table (query_id, query_text) and
return DataFrames, so a batch of queries is one job.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex import decisions as D
from glimmerdex.operators import embed, hybrid, lexical, lookup, rag, shaping, tuning, vector
from glimmerdex.operators.documents import build_documents
from glimmerdex.operators.filters import to_column
from glimmerdex.operators.lexical import LexicalIndex
from glimmerdex.operators.ranking import most_rows, retriever, without_score
from glimmerdex.operators.upsert import validate
from glimmerdex.plans.sizing import written
from glimmerdex.sources.corpus import corpus_from_texts
from glimmerdex.sources.index_store import IndexStore

Queries = str | list[str] | DataFrame


class SearchIndex:
    """An index under a root folder every executor can reach.

    `model` is a callable (texts, is_query) -> vectors; without one, hashed term
    counts of `dims` dimensions stand in.
    """

    def __init__(
        self, spark: SparkSession, root: str, index: str, model: embed.Model | None = None, dims: int = 256,
        create_if_missing: bool = False, text_field: str = "text", vector_field: str = "embedding",
        base_uri: str = D.DEFAULT_BASE_URI, columns: dict[str, str] | None = None, saved_tuning: dict | None = None,
    ):
        if not index:
            raise ValueError("an index needs a name")
        self.spark = spark
        self.store = IndexStore(spark, root, index).require(create_if_missing)
        self.index = index
        self.model = model
        self.dims = dims
        self.text_field = text_field
        self.vector_field = vector_field
        self.base_uri = base_uri
        self.columns = columns
        self.saved_tuning = saved_tuning

    @classmethod
    def from_texts(cls, spark, root, texts, metadatas=None, *, index, ids=None, **options) -> SearchIndex:
        store = cls(spark, root, index, create_if_missing=True, **options)
        store.add_texts(texts, metadatas, ids)
        return store

    # -- writing ----------------------------------------------------------

    def add_texts(self, texts: list[str], metadatas: list[dict] | None = None, ids: list[str] | None = None) -> list[str]:
        """Add a small list of texts; returns the document keys in order."""
        if not texts:
            return []
        given = [json.dumps(m or {}, ensure_ascii=False) for m in metadatas] if metadatas else None
        rows = corpus_from_texts(self.spark, texts, given, ids)
        if ids is None:
            # Written keys must be the returned ones, so random ids are drawn once.
            rows = self.spark.createDataFrame(
                [(r["text"], r["metadata"], r["seq"], r["id"]) for r in rows.withColumn("id", F.uuid()).collect()],
                "text string, metadata string, seq long, id string",
            )
        documents = build_documents(rows, self.index, metadata_json="metadata", seq=F.col("seq"), base_uri=self.base_uri)
        self.store.upsert(self._embedded(documents))
        return [r["doc_key"] for r in documents.orderBy("ingest_seq").select("doc_key").collect()]

    def add_table(
        self, source: DataFrame, id_col: str = "id", text_col: str = "text", metadata_cols: list[str] | None = None,
        metadata_json: str | None = None, embedding_col: str | None = None, order_col: str | None = None,
    ) -> DataFrame:
        """Add a table of any size; returns the rejected rows with their reason.

        Of rows with one id the last by `order_col` is taken, and among equals, or without
        such a column, the last as the table is read. Vectors must have the length of those
        already stored, or else of most vectors of the table.
        """
        row = F.struct((F.col(order_col) if order_col else F.lit(0)).alias("order"), F.monotonically_increasing_id().alias("row"))
        # Numbers of rows are drawn once, so that accepted and rejected rows agree.
        numbered = written(source.withColumn("_order", row), "numbered")
        dims = self._vector_length(numbered, embedding_col) if embedding_col else None
        checked = written(validate(numbered, id_col, text_col, "_order", embedding_col, dims), "checked")
        documents = build_documents(
            checked.filter(F.col("reason").isNull()), self.index, id_col, text_col, metadata_cols, metadata_json,
            embedding_col, F.col("_order.order" if order_col else "_order.row"), base_uri=self.base_uri,
        )
        self.store.upsert(documents if embedding_col else self._embedded(documents))
        return checked.filter(F.col("reason").isNotNull()).drop("_order")

    def _vector_length(self, source: DataFrame, embedding_col: str) -> int | None:
        for rows, column in ((self.documents(), "embedding"), (source, embedding_col)):
            sizes = rows.filter(F.col(column).isNotNull()).groupBy(F.size(column).alias("dims")).count()
            most = sizes.orderBy(F.desc("count"), "dims").first()
            if most is not None:
                return most["dims"]
        return None

    def _embedded(self, documents: DataFrame) -> DataFrame:
        documents = documents.drop("embedding")
        if self.model is None:
            return embed.hash_embed(documents, self.dims)
        return embed.embed_documents(documents, self.model)

    def delete(self, ids: list[str] | DataFrame | None = None, query=None, delete_all: bool = False) -> bool:
        if isinstance(ids, list):
            ids = self.spark.createDataFrame([(str(i),) for i in ids], "id string")
        if isinstance(query, dict):
            query = to_column(query, self.columns)
        self.store.delete(ids, query, delete_all)
        return True

    def publish(self) -> None:
        """Write search tables of the current documents. Keyword and hybrid searches use them until documents change."""
        weightings = tuple(self._weights(w) for w in (D.LEXICAL_WEIGHTS, D.HYBRID_WEIGHTS))
        self.store.publish(sorted({f for w in weightings for f in w}), weightings)

    def _searched(self, documents: DataFrame, weights: dict[str, float]) -> DataFrame | LexicalIndex:
        """The published tables where they are up to date, else the documents."""
        return self.store.published(sorted(weights)) or documents

    # -- reading ----------------------------------------------------------

    def documents(self) -> DataFrame:
        return self.store.read()

    def get_by_ids(self, ids: list[str]) -> DataFrame:
        ids = [str(i) for i in ids]
        found = lookup.get_by_ids(self.store.read_holding(ids), lookup.request_table(self.spark, ids))
        return shaping.result_shape(found, self.text_field).select("pos", "doc_key", "page_content", "metadata").orderBy("pos")

    def queries(self, queries: Queries) -> DataFrame:
        if isinstance(queries, DataFrame):
            return queries
        texts = [queries] if isinstance(queries, str) else list(queries)
        return self.spark.createDataFrame(list(enumerate(texts)), "query_id long, query_text string")

    def embed_query(self, queries: Queries) -> DataFrame:
        rows = self.queries(queries)
        if "query_vec" in rows.columns:
            return rows
        if self.model is None:
            return embed.hash_embed(rows, self.dims, "query_text", "query_vec")
        return embed.embed_queries(rows, self.model)

    def similarity_search_with_score(
        self, query: Queries, k: int = D.DEFAULT_K, filter=None, hybrid: bool = False, lexical: bool = False,
        mode: str = "union", alpha: float = 0.5,
    ) -> DataFrame:
        """(query_id, rank, doc_key, score, page_content, metadata); lexical wins over hybrid."""
        documents = self.documents()
        query = self.queries(query)
        hits = self._hits(documents, query, k, filter, hybrid, lexical, mode, alpha)
        return shaping.shaped_results(hits, documents, self.text_field, at_most=most_rows(query, k))

    def _hits(self, documents, query, k, filter, is_hybrid, is_lexical, mode, alpha) -> DataFrame:
        where = to_column(filter, self.columns)
        if is_lexical:
            weights = self._weights(D.LEXICAL_WEIGHTS)
            return lexical.lexical_search(self._searched(documents, weights), self.queries(query), k, weights, where)
        if is_hybrid:
            hybrid.check_mode(mode)
            weights = self._weights(D.HYBRID_WEIGHTS)
            return hybrid.hybrid_search(
                self._searched(documents, weights), self.embed_query(query), k, mode, alpha, where, None, weights, self.vector_field
            )
        return vector.knn_search(documents, self.embed_query(query), k, self.vector_field, where)

    def _weights(self, weights: dict[str, float]) -> dict[str, float]:
        return {self.text_field if name == "text" else name: weight for name, weight in weights.items()}

    def similarity_search(self, query: Queries, k: int = D.DEFAULT_K, filter=None, **options) -> DataFrame:
        return without_score(self.similarity_search_with_score(query, k, filter, **options))

    def similarity_search_by_vector(self, embedding: list[float] | DataFrame, k: int = D.DEFAULT_K, filter=None) -> DataFrame:
        if not isinstance(embedding, DataFrame):
            embedding = self.spark.createDataFrame([(0, [float(x) for x in embedding])], "query_id long, query_vec array<double>")
        documents = self.documents()
        hits = vector.knn_search(documents, embedding, k, self.vector_field, to_column(filter, self.columns))
        at_most = most_rows(embedding, k)
        return without_score(shaping.shaped_results(hits, documents, self.text_field, at_most=at_most))

    def hybrid_search(self, query: Queries, rows: int = D.HYBRID_DEFAULT_K, mode: str = "union", alpha: float = 0.5, fields: str = "*,score", filter=None) -> DataFrame:
        """Stored fields of the hits, chosen by `fields`."""
        documents, query = self.documents(), self.queries(query)
        hits = self._hits(documents, query, rows, filter, True, False, mode, alpha)
        stored = [c for c in documents.columns if c != "doc_key"]
        found = shaping.attach_documents(hits, documents, stored, most_rows(query, rows))
        return shaping.field_list(found, f"query_id,rank,{fields}")

    def embed_and_search(self, query: Queries, rows: int = D.TUNED_DEFAULT_ROWS, quality: DataFrame | None = None, as_of: str | None = None, **knobs) -> DataFrame:
        documents, query = self.documents(), self.queries(query)
        hits = self._tuned(documents, query, rows, knobs, quality, as_of)
        return shaping.shaped_results(hits, documents, self.text_field, at_most=most_rows(query, rows))

    def _tuned(self, documents, query, rows, knobs, quality=None, as_of=None) -> DataFrame:
        settled = tuning.knobs(knobs, self.saved_tuning)
        searched = self._searched(documents, settled["weights"])
        return hybrid.tuned_search(searched, self.embed_query(query), settled, rows, None, quality, as_of, self.vector_field)

    def as_retriever(self, **options) -> Callable[..., DataFrame]:
        return retriever(self.similarity_search_with_score, **options)

    # -- answers ----------------------------------------------------------

    def rag_context(self, query: Queries, filter=None, docs: int | None = None, words: int | None = None, tuning: dict | None = None) -> DataFrame:
        """(query_id, context): tuned retrieval, then plain hybrid for queries without a hit.

        A filter goes to hybrid retrieval directly.
        """
        documents, query = self.documents(), self.queries(query)
        docs = docs or D.RAG_DOCS
        plain = self._hits(documents, query, docs, filter, True, False, "union", 0.5)
        hits = plain if filter is not None else lookup.with_fallback(self._tuned(documents, query, docs, tuning or {}), plain)
        return rag.rag_context(hits, documents, docs, words, query.count())

    def ai_answer(
        self, query: Queries, filter=None, rag_docs: int = D.RAG_DOCS, rag_words: int = D.RAG_WORDS,
        instruction: str | None = None, tuning: dict | None = None, answer_model: Callable | None = None,
    ) -> DataFrame:
        """One prompt row per query, with an answer when a model is given.

        Queries that bring their own text in a `context` column are not searched, those
        without one are.
        """
        rows = self.queries(query)
        asked = rows.filter(F.col("context").isNull()).drop("context") if "context" in rows.columns else rows
        contexts = self.rag_context(asked, filter, rag_docs, rag_words, tuning)
        prompts = rag.rag_prompt(rows, contexts, instruction)
        return prompts if answer_model is None else rag.answer(prompts, answer_model)
