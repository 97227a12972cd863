"""Where an index is kept: parquet segments listed by a committed state.

    <root>/<index>/log/<version>.json              the state, one file per version (see `manifest`)
    <root>/<index>/segments/<segment>/<writing>    the rows
    <root>/<index>/sketches/<writing>              which of its files may hold a key (see `sketches`)
    <root>/<index>/jobs/<job>                      one row per ingest job

The first segment is the base; upserts and removals are small segments after it, and the
last one counts for each key. Every writing has a folder of its own, so nothing that is
being read is ever overwritten: rows are written first and count once a version of the
state lists them. Writers do not wait for each other: a change is worked out from one
version and made on the newest one, where it is checked again. An upsert always holds; a
removal by id or predicate is worked out anew when segments were added meanwhile; a
compaction gives way to whatever changed the segments it has read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from glimmerdex import decisions as D
from glimmerdex.operators import bounded, lexical, upsert
from glimmerdex.operators.documents import INDEX_SCHEMA, empty_index
from glimmerdex.operators.filters import to_column
from glimmerdex.operators.lexical import LexicalIndex
from glimmerdex.plans import sizing
from glimmerdex.plans.sizing import broadcast_if_small, is_small, keyed_join, measure, shuffles_removed, text_parts, within_bounds, written
from glimmerdex.sources import manifest, sketches
from glimmerdex.sources.commits import CommitLog, Conflict, Folder

ROWS_PER_FILE = 100_000
SKETCH_ROWS = 10_000  # smaller segments are opened without asking
NAMES_ASKED = 1_000  # look-ups of more names scan the index
TRIES = 20
SETTLED = (D.LEXICAL_WEIGHTS, D.HYBRID_WEIGHTS)
REMOVAL_SCHEMA = "doc_key string, ingest_seq long"
_WRITING = "([0-9a-f]{32})/[^/]+$"  # of a data file's path, the writing it belongs to


def conform(documents: DataFrame, keep: dict[str, Column] | None = None) -> DataFrame:
    """Columns and types of the index, after those to keep; missing ones are null."""
    have = set(documents.columns)
    return documents.select(
        *[c.alias(name) for name, c in (keep or {}).items()],
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in INDEX_SCHEMA.fields],
    )


def segments_at(spark: SparkSession, folder: str) -> list[dict]:
    """The segments of the index in a folder, none if there is no index."""
    _, state = CommitLog(Folder(spark, f"{folder}/log")).latest()
    return state["segments"] if state else []


class IndexStore:
    def __init__(self, spark: SparkSession, root: str, index: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.index = index
        self.folder = f"{self.root}/{index}"
        self.log = CommitLog(Folder(spark, f"{self.folder}/log"))

    # -- segments ---------------------------------------------------------

    def manifest(self) -> list[dict]:
        """The segments in order; their number is kept small by `compact`."""
        return segments_at(self.spark, self.folder)

    def exists(self) -> bool:
        return bool(self.manifest())

    def _write(self, rows: DataFrame, kind: str, segment: str | None = None, at_most: int | None = None, origin: str | None = None) -> dict:
        """Write the rows of a segment, which no state lists yet.

        A known greatest number of rows keeps small segments in few files. Rows and vectors are counted on the way.
        """
        if at_most is not None:
            rows = rows.coalesce(1 + at_most // ROWS_PER_FILE)
        name, writing = segment or f"{kind}-{uuid.uuid4().hex}", uuid.uuid4().hex
        path = f"{self.folder}/segments/{name}/{writing}"
        seen, vectors = Observation(), F.count("embedding" if "embedding" in rows.columns else F.lit(None))
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), vectors.alias("vectors")).write.parquet(path)
        entry = {"segment": name, "named": segment is not None, "origin": origin, "kind": kind, "path": path}
        entry |= {"rows": seen.get["rows"], "vectors": seen.get["vectors"]}
        if kind != "removal" and entry["rows"] >= SKETCH_ROWS:
            sketch = f"{self.folder}/sketches/{writing}"
            entry |= {"sketch": sketch, "bits": sketches.write(self.spark, path, sketch)}
        return entry

    def make_visible(self, pending: dict) -> None:
        """Commit a change that was written with visible=False. Raises Conflict if it no longer holds."""
        entry, change, paths = pending["entry"], pending["change"], pending.get("paths")
        made = {
            "added": lambda state: manifest.added(state, entry),
            "replaced": lambda state: manifest.replaced(state, entry),
            "compacted": lambda state: manifest.compacted(state, entry, paths),
        }[change]
        self.log.commit(made)

    def _pending(self, entry: dict, change: str, visible: bool, paths: list[str] | None = None) -> dict:
        pending = {"entry": entry, "change": change, "paths": paths}
        if visible:
            self.make_visible(pending)
        return pending

    # -- content ----------------------------------------------------------

    def create(self) -> IndexStore:
        if not self.exists():
            entry = self._write(empty_index(self.spark), "base")
            self.log.commit(lambda state: state or manifest.replaced(state, entry))
        return self

    def require(self, create_if_missing: bool = False) -> IndexStore:
        if not self.exists():
            if not create_if_missing:
                raise ValueError(f"index {self.index!r} does not exist")
            self.create()
        return self

    def replace(self, documents: DataFrame, visible: bool = True) -> dict:
        """Publish a whole new content; `documents` has one row per key."""
        return self._pending(self._write(conform(documents), "base"), "replaced", visible)

    def upsert(
        self, documents: DataFrame, segment: str | None = None, visible: bool = True, at_most: int | None = None, origin: str | None = None
    ) -> dict:
        """Add or replace documents; only the given ones are written. A named segment may be written again, as
        a replayed batch does; `origin` tells series of the same name apart."""
        entry = self._write(upsert.latest(conform(documents)), "upsert", segment, at_most, origin)
        return self._pending(entry, "added", visible)

    def remove(self, keys: DataFrame) -> dict:
        return self._pending(self._removal(keys), "added", True)

    def _removal(self, keys: DataFrame) -> dict:
        return self._write(keys.select("doc_key", F.lit(0).cast("long").alias("ingest_seq")), "removal")

    def delete(self, ids: DataFrame | None = None, query=None, delete_all: bool = False) -> None:
        """Remove by ids, by predicate, or everything; only keys are written."""
        by_query = isinstance(query, Column) or bool(query)
        if not by_query and ids is None:
            if not delete_all:
                raise ValueError("give ids, a query, or delete_all=True")
            self.replace(empty_index(self.spark))
            return
        for _ in range(TRIES):
            entries = self._entries()
            paths = [e["path"] for e in entries]
            entry = self._removal(self._matching(entries, ids, query if by_query else None))
            try:
                self.log.commit(lambda state: manifest.unchanged_since(state, paths) or manifest.added(state, entry))  # noqa: B023
                return
            except Conflict:
                continue
        raise Conflict(f"segments were added during each of {TRIES} tries")

    def _matching(self, entries: list[dict], ids: DataFrame | None, query) -> DataFrame:
        """The keys of documents that are listed or fulfil the predicate."""
        if query is not None:
            return self._content(entries).filter(F.coalesce(to_column(query), F.lit(False))).select("doc_key")
        listed = ids.select(F.col("id").cast("string").alias("_id")).distinct()
        few = [r["_id"] for r in listed.limit(NAMES_ASKED + 1).collect()]
        now = self._holding(entries, [n for n in few if n is not None]) if len(few) <= NAMES_ASKED else self._content(entries)
        names = F.explode(F.array_distinct(F.array("doc_key", "ext_id"))).alias("_id")
        return keyed_join(now.select("doc_key", names), listed, ["_id"], "doc_key", "left_semi").select("doc_key").distinct()

    def compact(self) -> bool:
        """Fold all segments into a new base; what is added meanwhile is kept beside it. False if others changed
        the folded segments each time, as another compaction does."""
        for _ in range(TRIES):
            try:
                self.make_visible(self.prepare_compaction())
                return True
            except Conflict:
                if len(self.manifest()) == 1:  # someone else has folded them
                    return False
        return False

    def prepare_compaction(self) -> dict:
        """The base that folds all segments of now, for `make_visible`."""
        entries = self.manifest()
        entry = self._write(conform(self._content(entries)), "base")
        return self._pending(entry, "compacted", False, [e["path"] for e in entries])

    def _entries(self) -> list[dict]:
        entries = self.manifest()
        if not entries:
            raise ValueError(f"index {self.index!r} does not exist")
        return entries

    def read(self) -> DataFrame:
        """The current documents, one row per key.

        Base rows are not shuffled: they leave by an anti join against the keys
        of later segments, broadcast when their measured size allows.
        """
        return self._content(self._entries())

    def read_holding(self, names: list[str]) -> DataFrame:
        """Of the current documents at least those whose key or original id is among the names.

        Only files that may hold one of them are opened. Up to NAMES_ASKED names, more scan the index."""
        entries, names = self._entries(), sorted({n for n in names if n is not None})
        return self._holding(entries, names) if len(names) <= NAMES_ASKED else self._content(entries)

    def _holding(self, entries: list[dict], names: list[str]) -> DataFrame:
        """A document found by an original id may have been replaced by one with another, so the second look is for its key."""
        if not any("sketch" in e for e in entries):
            return self._content(entries)
        if not names:
            return empty_index(self.spark)
        old = self._documents(entries, self._files(entries, names, False))
        listed = F.broadcast(self.spark.createDataFrame([(n,) for n in names], "_id string"))
        by_name = old.select("doc_key", F.explode(F.array("doc_key", "ext_id")).alias("_id")).join(listed, "_id", "left_semi")
        keys = [r["doc_key"] for r in by_name.select("doc_key").distinct().limit(NAMES_ASKED + 1).collect()]
        if len(keys) > NAMES_ASKED:
            return self._content(entries)
        return self._content(entries, self._files(entries, sorted({*keys, *names}), True))

    def _files(self, entries: list[dict], names: list[str], keys_only: bool) -> dict[str, list[str]]:
        """Per sketched segment the files that may hold a name."""
        known = {e["path"]: (e["sketch"], e["bits"]) for e in entries if "sketch" in e}
        chosen: dict[str, list[str]] = {path: [] for path in known}
        for path, file in sketches.holding(self.spark, known, names, keys_only):
            chosen[path].append(f"{path}/{file}")
        return chosen

    def _content(self, entries: list[dict], chosen: dict[str, list[str]] | None = None) -> DataFrame:
        """The rows that count, from all files or of some segments from chosen ones."""
        base, later = self._documents(entries[:1], chosen), entries[1:]
        upserts, gone_paths = [e for e in later if e["kind"] == "upsert"], [e["path"] for e in later if e["kind"] == "removal"]
        if not later:
            return base
        changed = self._documents(upserts, chosen).withColumn("_gone", F.lit(False))
        if gone_paths:
            gone = self._placed(self.spark.read.schema(REMOVAL_SCHEMA).parquet(*gone_paths), later).withColumn("_gone", F.lit(True))
            changed = changed.unionByName(gone, allowMissingColumns=True)
        keys = broadcast_if_small(changed.select("doc_key").distinct())
        newest = upsert.latest(changed).filter(~F.col("_gone")).drop("_gone")
        return base.join(keys, "doc_key", "left_anti").unionByName(newest)

    def _documents(self, entries: list[dict], chosen: dict[str, list[str]] | None = None) -> DataFrame:
        entries = [e for e in entries if e["kind"] != "removal"]
        files = [f for e in entries for f in (chosen or {}).get(e["path"], [e["path"]])]
        if not files:
            return empty_index(self.spark)
        reader = self.spark.read.schema(INDEX_SCHEMA)
        if chosen:  # single files beside whole folders
            reader = reader.option("recursiveFileLookup", "true")
        return self._placed(reader.parquet(*files), entries)

    def _placed(self, rows: DataFrame, entries: list[dict]) -> DataFrame:
        """ingest_seq is the position of the segment a row was read from."""
        if len({e["position"] for e in entries}) == 1:
            return rows.withColumn("ingest_seq", F.lit(entries[0]["position"]).cast("long"))
        positions = F.create_map(*[F.lit(x) for e in entries for x in (e["path"][-32:], e["position"])])
        return rows.withColumn("ingest_seq", F.element_at(positions, F.regexp_extract("_metadata.file_path", _WRITING, 1)).cast("long"))

    # -- search tables ----------------------------------------------------

    def _published_log(self) -> CommitLog:
        return CommitLog(Folder(self.spark, f"{self.folder}/published/log"))

    def publish(self, fields: list[str], weightings: tuple[dict[str, float], ...] = SETTLED, buckets: int | None = None) -> LexicalIndex:
        """Write search tables of the current documents, under a name of their own: tables that are being read stay."""
        entries, name = self._entries(), f"published_{uuid.uuid4().hex}"
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        index = publish_lexical(self._content(entries), f"{self.folder}/published/{name}", name, fields, buckets, weightings)
        state = {"name": name, "buckets": buckets, "fields": fields, "paths": [e["path"] for e in entries]}
        self._published_log().commit(lambda _: state)
        return index

    def published(self, fields: list[str]) -> LexicalIndex | None:
        """The search tables, if they hold these fields of the documents as they are now."""
        _, state = self._published_log().latest()
        if not state or not set(fields) <= set(state["fields"]) or state["paths"] != [e["path"] for e in self.manifest()]:
            return None
        return open_lexical(self.spark, f"{self.folder}/published/{state['name']}", state["name"], state["buckets"])

    # -- jobs -------------------------------------------------------------

    def record_job(self, job: str, state: str, processed: int = 0, success: int = 0, failed: int = 0, error: str | None = None) -> None:
        """One row per job, replaced as the job moves on, so a replayed batch counts once."""
        row = [(job, state, processed, success, failed, error)]
        schema = "job_id string, state string, processed long, success long, failed long, error string"
        self.spark.createDataFrame(row, schema).coalesce(1).write.mode("overwrite").json(f"{self.folder}/jobs/{job}")

    def jobs(self) -> DataFrame:
        schema = "job_id string, state string, processed long, success long, failed long, error string"
        try:
            return self.spark.read.schema(schema).json(f"{self.folder}/jobs/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def list_indexes(spark: SparkSession, root: str) -> list[str]:
    """The names under a root, from its folders alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/log")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().getParent().getName() for s in found or [])


def describe_indexes(spark: SparkSession, root: str) -> DataFrame:
    """(index, n_docs, n_vectors) for every index under the root, empty ones with zeros.

    An index of one base is described by what was counted when it was written. The keys of all others are read in
    one scan over their segments."""
    root = root.rstrip("/")
    states = {name: segments_at(spark, f"{root}/{name}") for name in list_indexes(spark, root)}
    known = [(name, s[0]["rows"], s[0]["vectors"]) for name, s in states.items() if len(s) == 1]
    described = spark.createDataFrame(known, "index string, n_docs long, n_vectors long")
    open_ = [(e["path"][-32:], name, e["position"], e["kind"] == "removal", e["path"]) for name, s in states.items() if len(s) > 1 for e in s]
    if not open_:
        return described
    places = spark.createDataFrame([e[:4] for e in open_], "writing string, index string, position long, gone boolean")
    schema = "doc_key string, embedding array<float>"
    keys = spark.read.schema(schema).parquet(*[e[4] for e in open_]).select(
        "doc_key", F.col("embedding").isNotNull().alias("vector"), F.regexp_extract("_metadata.file_path", _WRITING, 1).alias("writing")
    )
    last = keys.join(F.broadcast(places), "writing").groupBy("index", "doc_key").agg(F.max(F.struct("position", "gone", "vector")).alias("last"))
    counted = last.groupBy("index").agg(
        F.count_if(~F.col("last.gone")).alias("n_docs"), F.count_if(~F.col("last.gone") & F.col("last.vector")).alias("n_vectors")
    )
    names = spark.createDataFrame([(name,) for name, s in states.items() if len(s) > 1], "index string")
    counted = names.join(counted, "index", "left").select("index", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("n_vectors", F.lit(0)).alias("n_vectors"))
    return described.unionByName(counted)


def publish_each(documents: DataFrame, root: str, by: str) -> None:
    """Replace the index of each value of a column, all by one write; rows without a value are left out.

    The rows of a value lie in a folder of their own, which its index takes as the base."""
    spark, root = documents.sparkSession, root.rstrip("/")
    shared = f"{root}/_shared/{uuid.uuid4().hex}"
    rows = conform(documents.filter(F.col(by).isNotNull()), keep={"_index": F.col(by).cast("string")})
    rows.withColumn("part", F.md5("_index")).write.partitionBy("part").parquet(shared)
    counts = spark.read.parquet(shared).groupBy("part", "_index").agg(F.count(F.lit(1)).alias("rows"), F.count("embedding").alias("vectors"))
    for r in counts.toLocalIterator():  # one row and one small file per index
        path = f"{shared}/part={r['part']}"
        entry = {"segment": f"base-{uuid.uuid4().hex}", "kind": "base", "path": path, "rows": r["rows"], "vectors": r["vectors"]}
        IndexStore(spark, root, r["_index"]).log.commit(lambda state: manifest.replaced(state, entry))  # noqa: B023


def publish_lexical(
    documents: DataFrame, path: str, table: str, fields: list[str], buckets: int | None = None,
    weightings: tuple[dict[str, float], ...] = SETTLED, by_bounds: bool = False,
) -> LexicalIndex:
    """Write the search tables of an index and open them. A path and a table name are used once.

    Documents and postings are bucketed alike by doc_key (postings sorted by term
    inside a bucket, so row groups carry tight term ranges), which spares later
    searches every shuffle before the top-k. Term and field statistics are kept
    beside them. For each of the weightings whose fields are all published, postings carry
    their weight, so that a search has only sums to make; with `by_bounds` they also lie by
    term in blocks of falling weight (see `bounded`).
    """
    spark = documents.sparkSession
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), text_parts(documents) or 0)
    settled = [w for w in weightings if set(w) <= set(fields)]

    def bucketed(rows: DataFrame, name: str, sort: str, in_place: bool = False, mode: str = "error") -> None:
        # The shuffle hashes as the buckets do, and what was counted bucket by bucket lies there: one file per bucket.
        writer = (rows if in_place else rows.repartition(buckets, "doc_key")).write.mode(mode).bucketBy(buckets, "doc_key").sortBy(sort)
        with shuffles_removed(spark):
            writer.options(path=f"{path}/{name}", compression="zstd").saveAsTable(f"{table}_{name}")

    bucketed(documents, "documents", "doc_key")
    kept = spark.table(f"{table}_documents")
    with shuffles_removed(spark):
        lexical.term_counts(kept, fields).write.parquet(f"{path}/terms")
    lexical.field_lengths(kept, fields).coalesce(1).write.parquet(f"{path}/fields")
    terms, lengths = spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/fields")
    rows = lexical.postings(kept, fields, by_key=True)
    if settled:
        stats = LexicalIndex(kept, terms=terms, fields=lengths).statistics(fields, None)
        weights = [lexical.best_weight(w).alias(f"weight_{i}") for i, w in enumerate(settled)]
        if not is_small(stats):
            stats = written(stats, "stats")
        common, rare = _by_frequency(stats, [f"df_{f}" for f in fields])
        known = F.broadcast(common.select("term"))
        bucketed(rows.join(F.broadcast(common), "term").select(*rows.columns, *weights), "postings", "term", True)
        if rare is not None:  # only these leave their place, and come back to files of their own
            others = rows.join(known, "term", "left_anti")
            others = keyed_join(others, rare, ["term"], "doc_key").select(*rows.columns, *weights)
            bucketed(others, "postings", "term", mode="append")
    else:
        bucketed(rows, "postings", "term", True)
    listed = [(i, f, float(w)) for i, chosen in enumerate(settled) for f, w in chosen.items()]
    spark.createDataFrame(listed, "weighting int, field string, weight double").coalesce(1).write.parquet(f"{path}/weights")
    frequent = terms.filter(F.col("df") * len(fields) > bounded.SHARD).select("term", "df")
    for i in range(len(settled) if by_bounds else 0):
        weighted = spark.table(f"{table}_postings").select("term", "doc_key", F.col(f"weight_{i}").alias("weight")).filter("weight > 0")
        with shuffles_removed(spark):
            bounded.blocks(weighted, frequent).write.option("compression", "zstd").parquet(f"{path}/blocks_{i}")
    return open_lexical(spark, path, table)


def _by_frequency(stats: DataFrame, counts: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Statistics of the most frequent terms, as many as may be broadcast, and of the others if there are any.

    Most terms of a large corpus are in a few documents, so most postings belong to the first."""
    n, size = measure(stats)
    if within_bounds(n, size):
        return stats, None
    frequency = F.greatest(F.lit(1), *[F.coalesce(c, F.lit(0)) for c in counts])
    level = F.floor(F.log2(frequency)).cast("int")
    room, least = min(sizing.MAX_BROADCAST_ROWS, sizing.MAX_BROADCAST_BYTES * n // size), None
    for r in stats.groupBy(level.alias("level")).count().sort(F.desc("level")).collect():  # a row per power of two
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    is_common = F.lit(False) if least is None else level >= least
    return stats.filter(is_common), stats.filter(~is_common)


def open_lexical(spark: SparkSession, path: str, table: str, buckets: int | None = None) -> LexicalIndex:
    """Open published search tables; `buckets` registers them in a catalog that lacks them."""
    for name, sort in (("documents", "doc_key"), ("postings", "term")):
        if not spark.catalog.tableExists(f"{table}_{name}"):
            if buckets is None:
                raise ValueError(f"table {table}_{name} is not in the catalog; give its number of buckets")
            schema = spark.read.parquet(f"{path}/{name}").schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(
                f"CREATE TABLE {table}_{name} ({columns}) USING parquet "
                f"CLUSTERED BY (doc_key) SORTED BY ({sort}) INTO {buckets} BUCKETS LOCATION '{path}/{name}'"
            )
    kept, weightings = Folder(spark, path).names(), {}
    for r in spark.read.parquet(f"{path}/weights").collect():  # a row per weighting and field
        weightings.setdefault(r["weighting"], {})[r["field"]] = r["weight"]
    return LexicalIndex(
        documents=spark.table(f"{table}_documents"),
        rows=spark.table(f"{table}_postings"),
        terms=spark.read.parquet(f"{path}/terms"),
        fields=spark.read.parquet(f"{path}/fields"),
        clustered=True,
        weighted=tuple((w, f"weight_{i}", spark.read.parquet(f"{path}/blocks_{i}") if f"blocks_{i}" in kept else None) for i, w in sorted(weightings.items())),
    )
