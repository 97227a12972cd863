"""BM25 keyword search for a table of queries.

Scores are taken document by document: the terms of a document meet the query
vocabulary (measured and broadcast), become one weight per (document, term), and are
summed per (query, document). On published tables bucketed by `doc_key` nothing is
shuffled before the final top-k, which ships k rows per query and task. Raw documents
are cut into words once and counted in the tasks (`matching.counted`); a row of counts
per document is shuffled, never a posting or a text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glimmerdex import decisions as D
from glimmerdex.functions.text import folded_tokens, query_clean, tokens
from glimmerdex.operators import bounded, matching
from glimmerdex.operators.filters import to_column
from glimmerdex.operators.ranking import rounded, top_k
from glimmerdex.plans import sizing
from glimmerdex.plans.sizing import dealt, few_splits, keyed_join, measure, written

# Field name to (column, analysis); a field not listed is analysed as it is named.
FIELD_ANALYSIS = {"text_t": ("text", folded_tokens)}


def _analysed(field: str) -> Column:
    column, analysis = FIELD_ANALYSIS.get(field, (field, tokens))
    return analysis(F.coalesce(F.col(column), F.lit("")))


def _token_columns(documents: DataFrame, fields: list[str], where: Column | None = None) -> DataFrame:
    """(doc_key, kept, terms_<field>…), `kept` for documents that pass the filter; the generator keeps later steps from
    tokenising again."""
    names = [f"terms_{f}" for f in fields]
    kept = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return documents.select("doc_key", kept.alias("kept"), F.stack(F.lit(1), *[_analysed(f) for f in fields]).alias(*names))


def field_terms(documents: DataFrame, fields: list[str]) -> DataFrame:
    """(doc_key, field, terms, dl): tokens and their number per document and field."""
    pairs = [c for f in fields for c in (F.lit(f), _analysed(f))]
    rows = documents.select("doc_key", F.stack(F.lit(len(fields)), *pairs).alias("field", "terms"))
    return rows.withColumn("dl", F.size("terms"))


def postings(
    documents: DataFrame, fields: list[str], vocabulary: DataFrame | None = None, by_key: bool = False
) -> DataFrame:
    """(doc_key, term, tf_<field>…, dl_<field>…), one row per document and term.

    With a vocabulary only its terms are counted, which happens before the
    aggregate. Documents partitioned by doc_key (`by_key`) are counted without a shuffle;
    others are when all terms count, whose rows are many times the texts.
    """
    if vocabulary is None and not by_key:
        documents = dealt(documents, "doc_key")
    lengths = [f"dl_{f}" for f in fields]
    # Lengths first, so that the generator below need not carry the token arrays along.
    measured = _token_columns(documents, fields).select(
        "doc_key", *[F.size(f"terms_{f}").alias(f"dl_{f}") for f in fields], *[f"terms_{f}" for f in fields]
    )
    numbered = [c for i, f in enumerate(fields) for c in (F.lit(i), F.col(f"terms_{f}"))]
    by_field = measured.select("doc_key", *lengths, F.stack(F.lit(len(fields)), *numbered).alias("field", "terms"))
    words = by_field.select("doc_key", *lengths, "field", F.explode_outer("terms").alias("term"))
    words = words.filter(F.col("term").isNotNull())
    if vocabulary is not None:
        words = words.join(vocabulary, "term", "left_semi")
    counts = [F.count(F.when(F.col("field") == i, 1)).cast("int").alias(f"tf_{f}") for i, f in enumerate(fields)]
    return words.groupBy("doc_key", *lengths, "term").agg(*counts)


def long_postings(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(doc_key, field, term, tf, dl): the same, one row per field."""
    triples = [c for f in fields for c in (F.lit(f), F.col(f"tf_{f}"), F.col(f"dl_{f}"))]
    return rows.select(
        "doc_key", "term", F.stack(F.lit(len(fields)), *triples).alias("field", "tf", "dl")
    ).filter(F.col("tf") > 0)


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term) for the distinct terms of each cleaned query."""
    words = F.array_distinct(tokens(query_clean("query_text")))
    return queries.select("query_id", F.explode_outer(words).alias("term")).filter(F.col("term").isNotNull())


def required_terms(n_terms: Column, spec: str | int) -> Column:
    """How many distinct query terms must match.

    Named levels, a number, a negative number (that many may miss), a percentage,
    a negative percentage, or conditions 'n<spec' applied above n terms.
    """
    spec = str(spec).strip()
    named = {"flexible": "1", "strict": "100%"}
    if spec == "balanced":
        return F.greatest(F.ceil(n_terms * 0.5).cast("int"), F.lit(1))
    spec = named.get(spec, spec)
    if "<" in spec:
        parts = [p.split("<", 1) for p in spec.replace("< ", "<").split()]
        result = n_terms
        for bound, rule in parts:
            result = F.when(n_terms > int(bound), required_terms(n_terms, rule)).otherwise(result)
        return result
    if spec.endswith("%"):
        share = float(spec[:-1]) / 100.0
        if share < 0:
            needed = n_terms - F.floor(n_terms * F.lit(-share)).cast("int")
        else:
            needed = F.floor(n_terms * F.lit(share)).cast("int")
    else:
        number = int(spec)
        needed = F.lit(number) if number >= 0 else n_terms + F.lit(number)
    return F.greatest(F.least(needed, n_terms), F.lit(1)).cast("int")


@dataclass(frozen=True)
class LexicalIndex:
    """What a search reads: documents, and once published also postings and statistics.

    `clustered` says that documents and postings are partitioned or bucketed by
    doc_key. `terms` holds (field, term, df) and `fields` (field, n_docs, avgdl).
    `weighted` has, per settled field weights, the column of the postings with the weight
    of each one, and the same by term in blocks if they were published for searches by bounds.
    """

    documents: DataFrame
    rows: DataFrame | None = None
    terms: DataFrame | None = None
    fields: DataFrame | None = None
    clustered: bool = False
    weighted: tuple[tuple[dict[str, float], str, DataFrame | None], ...] = ()

    def by_weight(self, weights: dict[str, float]) -> tuple[DataFrame | None, DataFrame] | None:
        """(blocks by term, postings by document) with the weights of a search, if they were published."""
        for known, column, blocks in self.weighted:
            if known == weights and self.rows is not None:
                return blocks, self.rows.filter(F.col(column) > 0).select("doc_key", "term", F.col(column).alias("weight"))
        return None

    def prepared(self) -> LexicalIndex:
        """Documents of a few splits are dealt by key over all slots; beyond that no text is shuffled, only matches."""
        return clustered(self.documents) if not self.clustered and few_splits(self.documents) else self

    def postings(self, fields: list[str], vocabulary: DataFrame | None, where: Column | None) -> DataFrame:
        documents = self.documents if where is None else self.documents.filter(where)
        if self.rows is None:
            return postings(documents, fields, vocabulary, self.clustered)
        rows = self.rows.filter(F.greatest(F.lit(0), *[F.col(f"tf_{f}") for f in fields]) > 0)
        if vocabulary is not None:
            rows = rows.join(vocabulary, "term", "left_semi")
        return rows if where is None else rows.join(documents.select("doc_key"), "doc_key", "left_semi")

    def statistics(self, fields: list[str], vocabulary: DataFrame | None) -> DataFrame:
        """(term, df_<field>…, n_docs_<field>…, avgdl_<field>…) over the whole index."""
        if self.terms is not None and self.fields is not None:
            known = self.terms.filter(F.col("field").isin(*fields))
            if vocabulary is not None:
                known = known.join(vocabulary, "term", "left_semi")
            # The fields table has one row per field.
            stats = known.join(F.broadcast(self.fields), "field")
        else:
            stats = collection_statistics(self.documents, fields, vocabulary)
        return stats.groupBy("term").agg(
            *[
                F.max(F.when(F.col("field") == f, F.col(c))).alias(f"{c}_{f}")
                for f in fields
                for c in ("df", "n_docs", "avgdl")
            ]
        )


def clustered(documents: DataFrame) -> LexicalIndex:
    """Documents partitioned by key once, for one or more searches."""
    return LexicalIndex(dealt(documents, "doc_key"), clustered=True)


def collection_statistics(documents: DataFrame, fields: list[str], vocabulary: DataFrame | None) -> DataFrame:
    """(field, term, df, n_docs, avgdl) in one pass over the documents.

    `vocabulary` is a broadcast table of the terms wanted; None counts every term.

    Each document and field yields a row with its length (term null) and one per
    distinct term; partial counts leave at most one row per term and task.
    """
    marker = F.array(F.lit(None).cast("string"))
    marked = field_terms(documents, fields).select(
        "field", "dl", F.posexplode_outer(F.concat(marker, F.array_distinct("terms"))).alias("pos", "term")
    )
    is_length = F.col("pos") == 0
    if vocabulary is not None:
        marked = marked.join(vocabulary.withColumn("_known", F.lit(True)), "term", "left")
        marked = marked.filter(is_length | F.col("_known"))
    counts = marked.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum(F.when(is_length, F.col("dl"))).alias("length")
    )
    if vocabulary is not None:
        # At most one row per field and vocabulary term, whose number was measured.
        field = Window.partitionBy("field")
        totals = counts.select(
            "field",
            "term",
            "df",
            F.max(F.when(F.col("term").isNull(), F.col("df"))).over(field).alias("n_docs"),
            F.max("length").over(field).alias("length"),
        )
    else:
        counts = written(counts, "term-counts")
        lengths = counts.filter(F.col("term").isNull()).select("field", F.col("df").alias("n_docs"), "length")
        # One row per field.
        totals = counts.drop("length").join(F.broadcast(lengths), "field")
    mean = F.col("length") / F.col("n_docs")
    return totals.filter(F.col("term").isNotNull()).withColumn("avgdl", mean).drop("length")


def term_counts(documents: DataFrame, fields: list[str]) -> DataFrame:
    """(field, term, df) for every term of the index."""
    return (
        field_terms(documents, fields)
        .select("field", F.explode_outer(F.array_distinct("terms")).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("field", "term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def field_lengths(documents: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n_docs, avgdl), one row per field."""
    return field_terms(documents, fields).groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl")
    )


def best_weight(weights: dict[str, float]) -> Column:
    """The weight of a posting: its best weighted field counts."""
    return F.greatest(F.lit(0.0), *[F.lit(float(w)) * bm25(f) for f, w in weights.items()])


def bm25(field: str) -> Column:
    """BM25 of one term in one field; 0 where the field lacks the term."""
    tf, dl, df, n, avgdl = (F.col(f"{c}_{field}") for c in ("tf", "dl", "df", "n_docs", "avgdl"))
    rarity = F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
    length = F.lit(1.0 - D.BM25_B) + F.lit(D.BM25_B) * dl / avgdl
    score = rarity * tf * F.lit(D.BM25_K1 + 1.0) / (tf + F.lit(D.BM25_K1) * length)
    return F.when(tf > 0, score).otherwise(F.lit(0.0))


def lexical_scores(
    index: LexicalIndex | DataFrame,
    queries: DataFrame,
    weights: dict[str, float],
    where=None,
    min_match: str | int | None = None,
    best: int | None = None,
) -> DataFrame:
    """(query_id, doc_key, score) of every matching document, scores not rounded.

    Per query term the best weighted field counts; terms add up. Statistics are
    those of the whole index, whatever the filter. With `best`, documents that so many
    others of their task surpass may be left out, which spares the rows of all pairs
    unless the vocabulary is too large to broadcast.
    """
    if isinstance(index, DataFrame):
        index = LexicalIndex(index)
    weights = {f: w for f, w in weights.items() if w > 0}
    if not weights:
        raise ValueError("at least one field needs a weight above zero")
    fields = list(weights)
    terms = query_terms(queries)
    n_terms, size = measure(terms)
    small = sizing.within_bounds(n_terms, size)
    by_blocks = best is not None and (small or sizing.is_small(terms.select("term").distinct()))
    index = index.prepared()
    known = matching.vocabulary(terms) if by_blocks else None
    numbers = F.broadcast(matching.numbered(terms, known)) if by_blocks else None
    # A vocabulary too large to broadcast filters little; the join with the statistics does it then.
    vocabulary = F.broadcast(terms.select("term").distinct()) if small else None
    if by_blocks:
        small, vocabulary = True, F.broadcast(numbers.select("term"))

    published = index.by_weight(weights)
    if min_match is not None:
        needed = terms.groupBy("query_id").agg(F.count(F.lit(1)).cast("int").alias("n_terms"))
        needed = needed.select("query_id", required_terms(F.col("n_terms"), min_match).alias("needed"))
        terms = terms.join(needed, "query_id")
    if by_blocks:
        most = [] if min_match is None else [F.max("needed").alias("needed")]
        asked = terms.join(numbers, "term").groupBy("query_id", "term_no").agg(F.count(F.lit(1)).alias("times"), *most)
        if not published and index.rows is None and index.terms is None:
            counts = matching.counted(_token_columns(index.documents, fields, to_column(where)), fields, known)
            return matching.best_counted(counts, asked, best, weights, len(known))
    if published:
        weighted = published[1] if vocabulary is None else published[1].join(vocabulary, "term", "left_semi")
        if where is not None:
            weighted = weighted.join(index.documents.filter(to_column(where)).select("doc_key"), "doc_key", "left_semi")
    else:
        stats = index.statistics(fields, vocabulary)
        matched = keyed_join(
            index.postings(fields, vocabulary, to_column(where)), stats, ["term"], "doc_key", small=small
        )
        weighted = matched.select("doc_key", "term", best_weight(weights).alias("weight"))
    if not index.clustered:
        # Before the queries multiply the rows, so it serves the sum as well.
        weighted = weighted.repartition("doc_key")
    if by_blocks:
        return matching.best_matches(weighted.join(numbers, "term").select("doc_key", "term_no", "weight"), asked, best)
    sums = [F.sum("weight").alias("score")]
    if min_match is not None:
        sums += [F.count(F.lit(1)).alias("_matched"), F.max("needed").alias("_needed")]
    scored = keyed_join(weighted, terms, ["term"], "doc_key", small=small).groupBy("query_id", "doc_key").agg(*sums)
    if min_match is None:
        return scored
    return scored.filter(F.col("_matched") >= F.col("_needed")).drop("_matched", "_needed")


def lexical_search(
    index: LexicalIndex | DataFrame,
    queries: DataFrame,
    k: int = D.DEFAULT_K,
    weights: dict[str, float] | None = None,
    where=None,
    min_match: str | int | None = None,
) -> DataFrame:
    """(query_id, doc_key, score, rank): keyword search; it needs no vectors."""
    return lexical_candidates(index, queries, k, weights or D.LEXICAL_WEIGHTS, where, min_match).drop("raw")


def lexical_candidates(index, queries, size: int, weights, where=None, min_match=None) -> DataFrame:
    """The best `size` documents per query with their rounded and their raw score.

    An index with blocks for these weights is searched by bounds, as long as every document and match counts."""
    if isinstance(index, LexicalIndex) and where is None and min_match is None:
        blocks, rows = index.by_weight({f: w for f, w in weights.items() if w > 0}) or (None, None)
        terms = query_terms(queries)
        if blocks is not None and sizing.is_small(terms):
            return bounded.search(blocks, rows, terms, size)
    scores = lexical_scores(index, queries, weights, where, min_match, size)
    return top_k(scores.withColumnRenamed("score", "raw").withColumn("score", rounded(F.col("raw"))), size)


def lexical_leg(
    index: LexicalIndex | DataFrame, queries: DataFrame, k: int = D.DEFAULT_K, where=None, pool: int | None = None,
    weights: dict[str, float] | None = None, min_match: str | int | None = None,
) -> DataFrame:
    """The keyword candidates of a hybrid search, raw scores included; descriptions are not searched."""
    return lexical_candidates(
        index, queries, D.pool_size(k, pool), weights or D.HYBRID_WEIGHTS, where, min_match
    )


def bm25_search(index: LexicalIndex | DataFrame, queries: DataFrame, field: str = "text", k: int = 10) -> DataFrame:
    """BM25 over one field."""
    return lexical_search(index, queries, k, {field: 1.0})
