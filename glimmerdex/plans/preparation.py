"""Registered queries: sources, document preparation, upserts and deletes, filters, shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from glimmerdex.functions import identity, metadata
from glimmerdex.functions.text import first_n_words, query_clean, tokens
from glimmerdex.operators import embed, enrich, filters, lookup, shaping, upsert
from glimmerdex.operators.documents import build_documents
from glimmerdex.plans import inputs as I
from glimmerdex.plans.inputs import query
from glimmerdex.plans.sizing import scratch_path, spread, text_parts
from glimmerdex.sources.corpus import DROPPED_ELEMENTS, corpus_scan as scan, page_source, unescape
from glimmerdex.sources.index_store import IndexStore, describe_indexes, publish_each
from glimmerdex.streaming import ingest

BASE = "https://corpus.example.org"

# -- sources and identity ---------------------------------------------------------


@query("corpus_scan", "SELECT CAST(doc_id AS VARCHAR) AS id, text, lang, source, n_chars FROM documents")
def corpus_scan(spark, sf):
    return scan(spark, f"{sf.rstrip('/')}/documents.parquet", "doc_id", "text", I.METADATA)


@query("doc_uri", f"""
SELECT page_id, 'given' AS variant, rtrim(url, '/') AS uri FROM pages
UNION ALL SELECT page_id, 'made', '{BASE}/pages/' || url_encode(url) FROM pages
UNION ALL SELECT page_id, 'not web', '{BASE}/pages/' || CAST(page_id AS VARCHAR) FROM pages
UNION ALL SELECT page_id, 'slashes', rtrim(url, '/') FROM pages""")
def doc_uri(spark, sf):
    """Given addresses, made ones, an unusable `uri` beside a usable `url`, and trailing slashes."""
    pages = I.table(spark, sf, "pages")
    none = F.lit(None).cast("string")
    own, url = F.col("page_id").cast("string"), F.col("url")

    def variant(name, *values):
        names = ("id", "uri", "url")
        return F.struct(F.lit(name).alias("variant"), *[v.alias(n) for v, n in zip(values, names)])

    variants = F.array(
        variant("given", own, F.lit(""), url),
        variant("made", url, none, none),
        variant("not web", own, F.concat(F.lit("ftp:"), url), url),
        variant("slashes", own, F.concat(url, F.lit("///")), none),
    )
    rows = pages.select("page_id", F.explode(variants).alias("v")).select("page_id", "v.*")
    uri = identity.document_uri(F.col("id"), F.col("uri"), F.col("url"), "pages")
    return rows.select("page_id", "variant", uri.alias("uri"))


@query("doc_key_md5", f"WITH {I.IDX} SELECT doc_id, uri, doc_key FROM idx")
def doc_key_md5(spark, sf):
    return I.documents(spark, sf).select(F.col("ext_id").cast("long").alias("doc_id"), "uri", "doc_key")


@query("title_description", f"""WITH {I.IDX}
SELECT doc_key, 'from text' AS variant, title, description FROM idx
UNION ALL SELECT doc_key, 'given', substr(source || ': ' || text, 1, 250), text FROM idx""")
def title_description(spark, sf):
    source = I.table(spark, sf, "documents")
    given = source.withColumn("title", F.concat_ws(": ", "source", "text")).withColumn("description", F.col("text"))
    plain = build_documents(source, I.INDEX, "doc_id").withColumn("variant", F.lit("from text"))
    titled = build_documents(given, I.INDEX, "doc_id", metadata_cols=["title", "description"])
    both = plain.unionByName(titled.withColumn("variant", F.lit("given")))
    return both.select("doc_key", "variant", "title", "description")


@query("meta_key_sanitize", "SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9_]+', '_', 'g'), '_') AS key FROM pages")
def meta_key_sanitize(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", metadata.sanitize_key(F.col("url")).alias("key"))


@query("meta_flatten", f"""WITH {I.IDX}
SELECT doc_key, 'lang' AS key, lang AS value FROM idx WHERE lang IS NOT NULL
UNION ALL SELECT doc_key, 'source', source FROM idx WHERE source IS NOT NULL
UNION ALL SELECT doc_key, 'n_chars', CAST(n_chars AS VARCHAR) FROM idx WHERE n_chars IS NOT NULL""")
def meta_flatten(spark, sf):
    return I.documents(spark, sf).select("doc_key", F.explode("meta").alias("key", "value"))


@query("meta_flatten_json", """
SELECT event_id, 'event_type' AS key, upper(event_type) AS value FROM events
UNION ALL SELECT event_id, 'user_id', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'on', 'true' FROM events
UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k') FROM events""")
def meta_flatten_json(spark, sf):
    """JSON metadata with clashing keys, nested values, nulls and reserved keys."""
    events = I.table(spark, sf, "events")
    json = F.concat(
        F.lit('{"Event Type": "'), F.col("event_type"), F.lit('", "event_type!": "'), F.upper("event_type"),
        F.lit('", "User.ID": '), F.col("user_id").cast("string"), F.lit(', "props": '), F.col("props"),
        F.lit(', "tags": ["a"], "on": true, "none": null, "ext_id": 5, "url": "x", '),
        F.expr("substring(props, 2)"),
    )
    return events.select("event_id", F.explode(metadata.flatten_json(json)).alias("key", "value"))


@query("meta_json", f"WITH {I.IDX} SELECT doc_key, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM idx")
def meta_json(spark, sf):
    fields = F.json_tuple("meta_json", *I.METADATA).alias(*I.METADATA)
    return I.documents(spark, sf).select("doc_key", fields)


@query("first_class_fields", """
SELECT doc_id, source AS author, lang AS category, CAST(NULL AS VARCHAR) AS content_type, CAST(n_chars AS VARCHAR) AS og_image,
       CAST(CAST(TIMESTAMP '2024-01-01' + (doc_id % 365) * INTERVAL 1 DAY AS DATE) AS VARCHAR) AS day, CASE WHEN n_chars > 1000 THEN true END AS rtf
FROM documents""")
def first_class_fields(spark, sf):
    day = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("doc_id") % 365).cast("int"))
    source = I.table(spark, sf, "documents").select(
        "doc_id", "text", F.col("source").alias("author"), F.col("lang").alias("category"),
        F.lit("").alias("content_type"), F.col("n_chars").alias("og_image"),
        day.cast("string").alias("timestamp"), (F.col("n_chars") > 1000).alias("rtf"),
    )
    fields = ["author", "category", "content_type", "og_image", "timestamp", "rtf"]
    docs = build_documents(source, I.INDEX, "doc_id", metadata_cols=fields)
    return docs.select(
        F.col("ext_id").cast("long").alias("doc_id"), "author", "category", "content_type", "og_image",
        F.col("timestamp").cast("date").cast("string").alias("day"), "rtf",
    )


def _page_text_sql(html: str) -> str:
    text = rf"regexp_replace({html}, '(?s)<!--.*?-->', ' ', 'g')"
    for name in DROPPED_ELEMENTS:
        text = rf"regexp_replace({text}, '(?is)<{name}(\s[^>]*)?>.*?</{name}\s*>', ' ', 'g')"
    return _unescape_sql(f"regexp_replace({text}, '<[^>]*>', ' ', 'g')")


# The references that the given pages hold; &amp; comes last.
_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&mdash;": "—", "&eacute;": "é", "&amp;": "&"}


def _unescape_sql(text: str) -> str:
    for reference, character in _REFERENCES.items():
        text = "replace({}, '{}', '{}')".format(text, reference, character.replace("'", "''"))
    return rf"trim(regexp_replace({text}, '[\s ]+', ' ', 'g'))"


_TITLE = r"regexp_extract(html, '(?is)<title(\s[^>]*)?>(.*?)</title\s*>', 2)"


@query("page_ingest", f"""WITH p AS (
  SELECT rtrim(url, '/') AS uri, {_unescape_sql(_TITLE)} AS title, coalesce(nullif({_page_text_sql('html')}, ''), ' ') AS text FROM pages)
SELECT md5(uri) AS doc_key, uri, substr(coalesce(nullif(title, ''), substr(text, 1, 100)), 1, 250) AS title,
       substr(text, 1, 200) AS description, text FROM p""")
def page_ingest(spark, sf):
    pages = page_source(spread(I.table(spark, sf, "pages"), "page_id"))
    docs = build_documents(pages, "pages", metadata_cols=["uri", "title", "description"])
    return docs.select("doc_key", "uri", "title", "description", "text")


@query("character_references", """
SELECT page_id, chr(CAST(8200 + page_id % 20000 AS INT)) || '|' || chr(CAST(161 + page_id % 90 AS INT)) || '|' || chr(CAST(128512 + page_id % 50 AS INT))
  || '|é à ’ € & < &nosuch; &lt; � & &#; 100' AS text FROM pages""")
def character_references(spark, sf):
    """References by decimal and hexadecimal number and by name, unknown and broken ones, and an escaped reference."""
    number = lambda start, size: (F.lit(start) + F.col("page_id") % size)
    text = F.concat(
        F.lit("&#"), number(8200, 20000).cast("string"), F.lit(";|&#x"), F.hex(number(161, 90)),
        F.lit(";|&#X"), F.lower(F.hex(number(128512, 50))),
        F.lit(";|&eacute; &agrave; &rsquo; &euro; &amp; &lt; &nosuch; &amp;lt; &#xD800; & &#; 100"),
    )
    return I.table(spark, sf, "pages").select("page_id", unescape(text).alias("text"))


# -- enrichment and embedding --------------------------------------------------------


def _language_sql() -> str:
    rows = ", ".join(f"('{lang}', '{w}')" for lang, words in enrich.STOP_WORDS.items() for w in dict.fromkeys(words.split()))
    return f"""WITH {I.IDX}, words(language, term) AS (VALUES {rows}),
tok AS (SELECT doc_key, unnest({I.sql_tokens('text')}) AS term FROM idx),
n AS (SELECT doc_key, language, count(*) AS n FROM tok JOIN words USING (term) GROUP BY ALL),
best AS (SELECT doc_key, language FROM (SELECT *, row_number() OVER (PARTITION BY doc_key ORDER BY n DESC, language) AS r FROM n) WHERE r = 1)
SELECT doc_key, lang, language FROM idx LEFT JOIN best USING (doc_key)"""


@query("enrich_language", _language_sql())
def enrich_language(spark, sf):
    docs = I.searchable(spark, sf).documents
    return enrich.language(docs).select("doc_key", "lang", "language")


@query("enrich_sentiment", f"""WITH {I.IDX},
lexicon AS (SELECT DISTINCT term, CASE WHEN len(term) % 2 = 0 THEN 1.0 ELSE -1.0 END AS weight
  FROM (SELECT unnest({I.sql_tokens('text')}) AS term FROM benchmark)),
tok AS (SELECT doc_key, unnest({I.sql_tokens('text')}) AS term FROM idx),
mean AS (SELECT doc_key, round(avg(CAST(weight AS DOUBLE)), 6) AS sentiment FROM tok JOIN lexicon USING (term) GROUP BY doc_key)
SELECT doc_key, sentiment FROM idx LEFT JOIN mean USING (doc_key)""")
def enrich_sentiment(spark, sf):
    words = I.queries(spark, sf).select(F.explode(tokens("query_text")).alias("term")).distinct()
    lexicon = words.withColumn("weight", F.when(F.length("term") % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0)))
    scored = enrich.sentiment(I.searchable(spark, sf).documents, lexicon)
    return scored.select("doc_key", F.round("sentiment", 6).alias("sentiment"))


def _shape_model(texts: list[str], is_query: bool) -> list[list[float]]:
    """A stand-in for a user's model: length, spaces, and which side was asked for."""
    return [[float(len(t)), float(t.count(" ")), 1.0 if is_query else 0.0] for t in texts]


_SHAPE = "CAST(length({0}) AS DOUBLE) AS a, CAST(length({0}) - length(replace({0}, ' ', '')) AS DOUBLE) AS b"


def _parts(column):
    return [F.col(column)[i].cast("double").alias(n) for i, n in enumerate("abc")]


@query("embed_documents", f"WITH {I.IDX} SELECT doc_key, {_SHAPE.format('text')}, CAST(0 AS DOUBLE) AS c FROM idx")
def embed_documents(spark, sf):
    docs = I.documents(spark, sf).select("doc_key", "text")
    return embed.embed_documents(docs, _shape_model).select("doc_key", *_parts("embedding"))


@query("embed_query", f"SELECT item_id AS query_id, {_SHAPE.format('text')}, CAST(1 AS DOUBLE) AS c FROM benchmark")
def embed_query(spark, sf):
    return embed.embed_queries(I.queries(spark, sf), _shape_model).select("query_id", *_parts("query_vec"))


def _embedded(spark, sf, **options):
    docs = I.searchable(spark, sf).documents.select("doc_key", "text")
    vectors = embed.hash_embed(docs, **options)
    return vectors.select("doc_key", F.posexplode("embedding").alias("slot", "value")).select(
        "doc_key", "slot", F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query("hash_embed")
def hash_embed(spark, sf):
    return _embedded(spark, sf)


@query("hash_embed_shape", f"WITH {I.IDX} SELECT doc_key, 64 AS dims, 1.0::DOUBLE AS norm FROM idx WHERE len({I.sql_tokens('text')}) > 0")
def hash_embed_shape(spark, sf):
    """Every text with a token has a vector of the asked length and of norm one, others have none."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    vectors = embed.hash_embed(I.documents(spark, sf).select("doc_key", "text"))
    return vectors.filter("embedding is not null").select("doc_key", F.size("embedding").alias("dims"), F.round(norm, 4).alias("norm"))


@query("hash_embed_md5", f"""WITH {I.IDX}, tok AS (SELECT doc_key, unnest({I.sql_tokens('text')}) AS term FROM idx),
h AS (SELECT doc_key, CAST('0x' || substr(md5(term), 1, 15) AS BIGINT) AS h FROM tok),
s AS (SELECT doc_key, CAST(h % 64 AS INTEGER) AS slot, sum(CASE WHEN (h >> 32) % 2 = 0 THEN 1 ELSE -1 END) AS v FROM h GROUP BY ALL),
norm AS (SELECT doc_key, sqrt(sum(v * v)) AS n FROM s GROUP BY doc_key),
slots AS (SELECT doc_key, n, CAST(unnest(range(64)) AS INTEGER) AS slot FROM norm WHERE n > 0)
SELECT doc_key, slot, round(CAST(CAST(coalesce(v, 0) / n AS FLOAT) AS DOUBLE), 6) AS value FROM slots LEFT JOIN s USING (doc_key, slot)""")
def hash_embed_md5(spark, sf):
    return _embedded(spark, sf, hasher=embed.md5_hash)


# -- validation, upserts, deletes -----------------------------------------------------


def _submitted(spark, sf):
    """A batch with gaps and repeats: labelled documents come twice, some without text or id."""
    docs = I.table(spark, sf, "documents").select("doc_id", "text", "source")
    labels = I.table(spark, sf, "labels")
    first = docs.join(labels, "doc_id", "left").select(
        F.when((F.col("quality") == 0) & (F.col("toxic") == 0), F.lit(None)).otherwise(F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("toxic") == 1, F.lit(None)).otherwise(F.col("text")).alias("text"), "source",
        F.lit(0).cast("long").alias("ingest_seq"), "doc_id",
    )
    again = docs.join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"), "text", "source", F.lit(1).cast("long").alias("ingest_seq"), "doc_id"
    )
    return first.unionByName(again)


_SUBMITTED_SQL = """batch AS (
  SELECT CASE WHEN quality = 0 AND toxic = 0 THEN NULL ELSE CAST(d.doc_id AS VARCHAR) END AS id,
         CASE WHEN toxic = 1 THEN NULL ELSE text END AS text, source, 0 AS ingest_seq
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
  UNION ALL SELECT CAST(d.doc_id AS VARCHAR), text, source, 1 FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
last AS (SELECT id, max(ingest_seq) AS last FROM batch WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY id),
checked AS (SELECT id, source, CAST(ingest_seq AS BIGINT) AS ingest_seq,
  CASE WHEN id IS NULL THEN 'missing_id' WHEN text IS NULL THEN 'missing_text' WHEN ingest_seq < last THEN 'replaced_in_batch' END AS reason
  FROM batch LEFT JOIN last USING (id))"""


@query("ingest_validate", f"WITH {_SUBMITTED_SQL} SELECT id, ingest_seq, reason FROM checked")
def ingest_validate(spark, sf):
    return upsert.validate(_submitted(spark, sf)).select("id", "ingest_seq", "reason")


@query("job_counts", f"""WITH {_SUBMITTED_SQL} SELECT source AS job_id, count(*) AS processed,
  count(*) FILTER (reason IS NULL) AS success, count(reason) AS failed FROM checked GROUP BY source""")
def job_counts(spark, sf):
    checked = upsert.validate(_submitted(spark, sf))
    return checked.groupBy(F.col("source").alias("job_id")).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(F.col("reason").isNull()).alias("success"),
        F.count("reason").alias("failed"),
    )


def _changes(spark, sf, seq=1):
    """Labelled documents again, with changed text; toxic ones a second time."""
    source = I.table(spark, sf, "documents").join(I.table(spark, sf, "labels"), "doc_id")
    once = source.withColumn("text", F.concat("text", F.lit(" quality "), F.col("quality").cast("string")))
    twice = source.filter("toxic = 1").withColumn("text", F.lit("withdrawn"))
    build = lambda rows, n: build_documents(rows, I.INDEX, "doc_id", "text", I.METADATA, seq=n, promote=tuple(I.PROMOTED))
    return build(once, seq).unionByName(build(twice, seq + 1))


_CHANGED_SQL = """changed AS (SELECT idx.*, CASE WHEN toxic = 1 THEN 'withdrawn' WHEN quality IS NOT NULL THEN text || ' quality ' || quality ELSE text END AS now,
  CASE WHEN toxic = 1 THEN 2 WHEN quality IS NOT NULL THEN 1 ELSE 0 END AS seq FROM idx LEFT JOIN labels USING (doc_id))"""


@query("upsert_by_uri", f"WITH {I.IDX}, {_CHANGED_SQL} SELECT doc_key, now AS text, CAST(seq AS BIGINT) AS ingest_seq FROM changed")
def upsert_by_uri(spark, sf):
    return upsert.upsert(I.documents(spark, sf), _changes(spark, sf)).select("doc_key", "text", "ingest_seq")


def _delete_list(spark, sf):
    """Keys of documents of low quality, original ids of toxic ones."""
    labels = I.table(spark, sf, "labels").withColumn("ext_id", F.col("doc_id").cast("string"))
    keys = I.documents(spark, sf).select("doc_key", "ext_id").join(labels.filter("quality = 0"), "ext_id")
    return keys.select(F.col("doc_key").alias("id")).unionByName(labels.filter("toxic = 1").select(F.col("ext_id").alias("id")))


@query("delete_by_ids", f"WITH {I.IDX} SELECT doc_key, ext_id FROM idx WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 OR toxic = 1)")
def delete_by_ids(spark, sf):
    return upsert.delete_by_ids(I.documents(spark, sf), _delete_list(spark, sf)).select("doc_key", "ext_id")


@query("delete_by_query", f"WITH {I.IDX} SELECT doc_key, quality FROM idx LEFT JOIN labels USING (doc_id) WHERE NOT coalesce(quality = 0 OR lang = 'fr', false)")
def delete_by_query(spark, sf):
    labels = I.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("ext_id"), "quality")
    docs = I.documents(spark, sf).join(labels, "ext_id", "left")
    return upsert.delete_by_query(docs, "quality = 0 OR meta['lang'] = 'fr'").select("doc_key", "quality")


@query("delete_all", "SELECT 'before' AS moment, count(*) AS n_docs FROM documents UNION ALL SELECT 'after', 0")
def delete_all(spark, sf):
    docs = I.documents(spark, sf)
    left = upsert.delete(docs, delete_all=True)
    count = F.count(F.lit(1)).alias("n_docs")
    return docs.agg(count).select(F.lit("before").alias("moment"), "n_docs").unionByName(
        left.agg(count).select(F.lit("after").alias("moment"), "n_docs")
    )


@query("index_write", f"""WITH {I.IDX}, {_CHANGED_SQL} SELECT doc_key, ext_id, title, now AS text, lang
FROM (SELECT *, substr(now, 1, 100) AS new_title FROM changed) WHERE seq < 2""".replace("ext_id, title, now", "ext_id, new_title AS title, now"))
def index_write(spark, sf):
    """Base, upsert and removal segments, published and read back."""
    store = IndexStore(spark, scratch_path(spark, "store"), I.INDEX)
    store.replace(I.documents(spark, sf))
    store.upsert(_changes(spark, sf))
    store.delete(query="text = 'withdrawn'")
    return store.read().select("doc_key", "ext_id", "title", "text", F.col("meta")["lang"].alias("lang"))


@query("index_list", """SELECT lang AS index, count(*) AS n_docs, count(vec_id) AS n_vectors
FROM documents LEFT JOIN embeddings ON vec_id = doc_id GROUP BY lang""")
def index_list(spark, sf):
    """One index per language, listed with its documents and vectors."""
    root = scratch_path(spark, "indexes")
    vecs = I.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    source = I.table(spark, sf, "documents").join(vecs, "doc_id", "left")
    documents = build_documents(source, F.col("lang"), "doc_id", "text", I.METADATA, embedding_col="embedding", promote=("lang",))
    publish_each(documents, root, "lang")
    return describe_indexes(spark, root)


# -- streaming ------------------------------------------------------------------------


def _streamed(spark, sf, times: int):
    """The submitted batch as a queue of files, ingested `times` times over."""
    root = scratch_path(spark, "stream")
    rows = _submitted(spark, sf)
    # The files grow in number; rows of an id lie in one file, rows without an id in all of them.
    files = max(4, text_parts(I.table(spark, sf, "documents")) or 0)
    rows = rows.repartition(files, "doc_id").select("id", "text", "source", "ingest_seq")
    rows.write.parquet(f"{root}/queue")
    store = IndexStore(spark, root, "stream")
    build = lambda batch, order: build_documents(batch, "stream", metadata_cols=["source"], seq=order)
    for run in range(times):
        source = ingest.file_stream(spark, f"{root}/queue", rows.schema, files_per_trigger=-(-files // 2))
        running = ingest.start_ingest(
            store, source, build, f"{root}/checkpoint-{run}", f"run{run}", order_col="ingest_seq"
        )
        ingest.wait(running)
    return store


_STREAM_SQL = f"""WITH {_SUBMITTED_SQL}
SELECT md5('{BASE}/stream/' || id) AS doc_key, id AS ext_id, source FROM checked WHERE reason IS NULL"""


def _stream_rows(store):
    return store.read().select("doc_key", "ext_id", F.col("meta")["source"].alias("source"))


@query("stream_ingest", _STREAM_SQL)
def stream_ingest(spark, sf):
    return _stream_rows(_streamed(spark, sf, 1))


@query("stream_upsert_replay", _STREAM_SQL)
def stream_upsert_replay(spark, sf):
    """The whole queue delivered twice leaves one row per document."""
    return _stream_rows(_streamed(spark, sf, 2))


@query("ingest_status", f"""WITH {_SUBMITTED_SQL} SELECT 'completed' AS state, count(*) AS processed,
  count(*) FILTER (reason IS NULL) AS success, count(reason) AS failed FROM checked""")
def ingest_status(spark, sf):
    return ingest.job_counts(_streamed(spark, sf, 1).jobs()).drop("jobs")


# -- filters and shaping ----------------------------------------------------------------


def _kept(spark, sf, filter, columns=None):
    return filters.apply(I.documents(spark, sf), filter, columns).select("doc_key")


@query("query_clean", """SELECT event_id, translate(props, '{}"', '   ') AS cleaned FROM events""")
def clean_query(spark, sf):
    return I.table(spark, sf, "events").select("event_id", query_clean("props").alias("cleaned"))


@query("filter_eq", f"WITH {I.IDX} SELECT doc_key FROM idx WHERE lang = 'en' AND source = 'src1'")
def filter_eq(spark, sf):
    return _kept(spark, sf, {"lang": "en", "Source": "src1"})


@query("filter_pushed", f"WITH {I.IDX} SELECT doc_key FROM idx WHERE lang = 'en' AND source IN ('src1', 'src2')")
def filter_pushed(spark, sf):
    """The same on promoted columns, where the predicate reaches the scan."""
    return _kept(spark, sf, {"lang": "en", "source": ["src1", "src2"]}, I.PROMOTED)


@query("filter_in", f"WITH {I.IDX} SELECT doc_key FROM idx WHERE source IN ('src1', 'src2', 'it''s')")
def filter_in(spark, sf):
    return _kept(spark, sf, {"source": ["src1", "src2", "it's"]})


@query("filter_expr", f"WITH {I.IDX} SELECT doc_key FROM idx WHERE lang = 'de' OR length(text) > 3000")
def filter_expr(spark, sf):
    return _kept(spark, sf, "meta['lang'] = 'de' OR length(text) > 3000")


@query("filter_all", f"WITH {I.IDX} SELECT doc_key FROM idx WHERE lang <> 'en' AND length(text) > 1000")
def filter_all(spark, sf):
    return _kept(spark, sf, ["meta['lang'] <> 'en'", "length(text) > 1000"])


@query("filter_range", f"WITH {I.IDX} SELECT doc_key FROM idx WHERE n_chars BETWEEN 500 AND 2000")
def filter_range(spark, sf):
    return _kept(spark, sf, filters.between("n_chars", 500, 2000))


@query("literal_binding", f"""WITH {I.IDX} SELECT doc_key FROM idx WHERE source = 'src1'""")
def literal_binding(spark, sf):
    """Quotes and backslashes in stored values and filter values match literally."""
    odd = F.concat(F.lit("it's \"a\" \\ "), F.col("source"))
    rows = I.table(spark, sf, "documents").withColumn("odd", odd)
    docs = build_documents(rows, I.INDEX, "doc_id", "text", ["odd"])
    return filters.apply(docs, {"odd": "it's \"a\" \\ src1"}).select("doc_key")


@query("field_list", f"WITH {I.IDX} SELECT doc_key, title, lang FROM idx")
def field_list(spark, sf):
    return shaping.field_list(I.documents(spark, sf), "doc_key, title, no_such_field, lang")


@query("result_shape", f"""WITH {I.IDX}
SELECT doc_key, 'stored' AS variant, text AS page_content, lang, source, CAST(n_chars AS VARCHAR) AS n_chars, CAST(NULL AS VARCHAR) AS ext_id FROM idx
UNION ALL SELECT doc_key, 'unreadable', text, lang, source, CAST(n_chars AS VARCHAR), ext_id FROM idx""")
def result_shape(spark, sf):
    docs = I.documents(spark, sf).withColumn("variant", F.lit("stored"))
    broken = docs.withColumn("meta_json", F.lit(None).cast("string")).withColumn("variant", F.lit("unreadable"))
    shaped = shaping.result_shape(docs.unionByName(broken))
    names = [*I.METADATA, "ext_id"]
    return shaped.select("doc_key", "variant", "page_content", *[F.col("metadata")[n].alias(n) for n in names])


@query("first_n_words", rf"""WITH {I.IDX}
SELECT doc_key, array_to_string(list_slice(list_filter(string_split_regex(text, '\s+'), lambda t: t <> ''), 1, 20), ' ') AS words FROM idx""")
def first_words(spark, sf):
    return I.documents(spark, sf).select("doc_key", first_n_words("text", 20).alias("words"))


_REQUESTS_SQL = f"""asked AS (
  SELECT doc_id * 2 AS pos, CASE WHEN quality = 1 THEN CAST(doc_id AS VARCHAR) ELSE md5({I.URI}) END AS id FROM labels
  UNION ALL SELECT doc_id * 2 + 1, CASE WHEN toxic = 1 THEN 'missing-' || doc_id ELSE CAST(doc_id AS VARCHAR) END FROM labels)"""


@query("get_by_ids", f"WITH {I.IDX}, {_REQUESTS_SQL} SELECT pos, id, doc_key, title FROM asked JOIN idx ON id = doc_key OR id = ext_id")
def get_by_ids(spark, sf):
    """Keys, original ids, missing ids and repeated ids in one request."""
    uri = identity.document_uri(F.col("doc_id").cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string"), I.INDEX)
    labels = I.table(spark, sf, "labels")
    own = F.col("doc_id").cast("string")
    first = labels.select(
        (F.col("doc_id") * 2).alias("pos"),
        F.when(F.col("quality") == 1, own).otherwise(identity.document_key(uri)).alias("id"),
    )
    second = labels.select(
        (F.col("doc_id") * 2 + 1).alias("pos"),
        F.when(F.col("toxic") == 1, F.concat(F.lit("missing-"), own)).otherwise(own).alias("id"),
    )
    found = lookup.get_by_ids(I.documents(spark, sf), first.unionByName(second))
    return found.select("pos", "id", "doc_key", "title")
