"""Source rows to index documents, in one projection without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex import decisions as D
from glimmerdex.functions import identity, metadata

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("doc_key", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("ext_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("og_image", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("rtf", T.BooleanType()),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
        T.StructField("meta_json", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("ingest_seq", T.LongType()),
    ]
)


def title_of(title: Column, text: Column) -> Column:
    """Given title, else the start of the text; cut to the title limit."""
    start = F.substring(text, 1, D.TITLE_FROM_TEXT_CHARS)
    return F.substring(F.coalesce(title, start), 1, D.TITLE_CHARS)


def description_of(description: Column, text: Column) -> Column:
    """Given description whole, else the start of the text."""
    return F.coalesce(description, F.substring(text, 1, D.DESCRIPTION_FROM_TEXT_CHARS))


def build_documents(
    source: DataFrame,
    index: str | Column,
    id_col: str = "id",
    text_col: str = "text",
    metadata_cols: list[str] | None = None,
    metadata_json: str | None = None,
    embedding_col: str | None = None,
    seq: Column | int = 0,
    promote: tuple[str, ...] = (),
    base_uri: str = D.DEFAULT_BASE_URI,
) -> DataFrame:
    """Index documents from a table of texts.

    Metadata is either typed columns (`metadata_cols`) or one JSON column
    (`metadata_json`). With neither, it is the empty object. A missing id
    column gives random ids. `promote` also keeps source columns as they are, so
    that filters on them reach the scan.
    """
    names = source.columns
    fields = [source.schema[c] for c in metadata_cols or []]
    doc_id = F.col(f"`{id_col}`").cast("string") if id_col in names else F.uuid()
    if metadata_json:
        given = F.coalesce(F.col(f"`{metadata_json}`"), F.lit("{}"))
        flat, field = metadata.flatten_json(given), lambda key: metadata.json_field(given, key)
    else:
        flat = metadata.flatten_columns(fields)
        field = lambda key: metadata.column_field(fields, key)
        given = (
            F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in fields]), {"ignoreNullFields": "false"})
            if fields
            else F.lit("{}")
        )
    embedding = F.col(f"`{embedding_col}`") if embedding_col else F.lit(None)
    text = F.coalesce(F.nullif(F.col(f"`{text_col}`"), F.lit("")), F.lit(" "))
    # The random id must be drawn once per row, so it gets its own projection.
    rows = source.withColumn("_id", doc_id).withColumn("_text", text)
    rows = rows.withColumn(
        "_uri", identity.document_uri(F.col("_id"), field("uri"), field("url"), index, base_uri)
    )
    seq_col = F.lit(seq) if isinstance(seq, int) else seq
    return rows.select(
        identity.document_key(F.col("_uri")).alias("doc_key"),
        F.col("_uri").alias("uri"),
        F.col("_id").alias("ext_id"),
        title_of(field("title"), F.col("_text")).alias("title"),
        description_of(field("description"), F.col("_text")).alias("description"),
        F.col("_text").alias("text"),
        *[field(name).alias(name) for name in D.FIRST_CLASS_TEXT_FIELDS],
        field("timestamp").try_cast("timestamp_ntz").alias("timestamp"),
        F.when(field("rtf").isNotNull(), F.lit(True)).alias("rtf"),
        flat.alias("meta"),
        given.alias("meta_json"),
        embedding.cast("array<float>").alias("embedding"),
        seq_col.cast("long").alias("ingest_seq"),
        *[F.col(f"`{c}`") for c in promote],
    )


def empty_index(spark) -> DataFrame:
    return spark.createDataFrame([], INDEX_SCHEMA)
