"""The user's view on a four-document corpus, the store beneath it, and streaming."""

import pytest
from pyspark.sql import functions as F

from glimmerdex.operators.documents import build_documents
from glimmerdex.sources.index_store import IndexStore, describe_indexes, list_indexes
from glimmerdex.store import SearchIndex
from glimmerdex.streaming import ingest

TEXTS = [
    "Tide tables list high and low water for every harbour",
    "The old lighthouse keeper paints ships on cold evenings",
    "A harbour pilot reads the tide and steers by the stars",
    "Rope is spun from hemp, tar and patience",
]
METAS = [
    {"section": "navigation", "shelf": 10}, {"section": "people", "shelf": 21},
    {"section": "navigation", "shelf": 32}, {"section": "crafts", "shelf": 43},
]
IDS = ["tides", "keeper", "pilot", "rope"]
# One axis per topic; what a model would see in the words.
TOPICS = ["tables list water", "lighthouse keeper paints artist", "pilot stars steers tide", "rope hemp tar spun"]


def topic_model():
    topics = [topic.split() for topic in TOPICS]
    return lambda texts, is_query: [[float(sum(w in t.lower() for w in topic)) for topic in topics] for t in texts]


@pytest.fixture
def index(spark, tmp_path):
    store = SearchIndex(spark, str(tmp_path), "corpus", topic_model(), create_if_missing=True)
    store.keys = store.add_texts(TEXTS, METAS, IDS)
    return store


def test_whole_life(spark, index):
    assert len(set(index.keys)) == 4 and all(len(k) == 32 for k in index.keys)
    # meaning
    top = index.similarity_search("lonely artist paints", k=1).collect()
    assert len(top) == 1 and "keeper" in top[0]["page_content"] and top[0]["metadata"]["section"] == "people"
    scored = index.similarity_search_with_score("water tables", k=2).orderBy("rank").collect()
    assert len(scored) == 2 and scored[0]["score"] > 0
    by_vector = index.similarity_search_by_vector([0.0, 0.0, 0.0, 1.0], k=1).collect()
    assert "hemp" in by_vector[0]["page_content"] and "score" not in by_vector[0].asDict()
    # hybrid, keywords
    hybrid = index.similarity_search("tide stars", k=2, hybrid=True, alpha=0.5).orderBy("rank").collect()
    assert hybrid and hybrid[0]["metadata"]["section"] == "navigation"
    words = index.similarity_search("tar hemp rope", k=2, lexical=True, hybrid=True, mode="ignored").orderBy("rank").collect()
    assert "hemp" in words[0]["page_content"]
    with pytest.raises(ValueError, match="mode"):
        index.similarity_search("x", hybrid=True, mode="both")
    # filters
    crafts = index.similarity_search("water rope", k=5, filter={"section": "crafts"}).collect()
    assert len(crafts) == 1 and "hemp" in crafts[0]["page_content"]
    ranked = index.similarity_search("water keeper pilot rope", k=5, filter="try_cast(meta['shelf'] as double) >= 21").collect()
    assert sorted(r["metadata"]["shelf"] for r in ranked) == ["21", "32", "43"]
    # by ids
    assert [r["metadata"]["section"] for r in index.get_by_ids([IDS[1], IDS[3]]).collect()] == ["people", "crafts"]
    assert index.get_by_ids(index.keys[:2]).count() == 2
    assert index.get_by_ids([]).count() == 0
    # a table of queries is one job
    many = index.similarity_search(["keeper", "hemp"], k=1).orderBy("query_id").collect()
    assert ["keeper" in many[0]["page_content"], "hemp" in many[1]["page_content"]] == [True, True]
    retrieve = index.as_retriever(k=1, hybrid=True)
    assert "keeper" in retrieve("keeper paints").first()["page_content"]
    # fields, tuning, answers
    fields = index.hybrid_search("keeper", rows=1, fields="title,score")
    assert fields.columns == ["query_id", "rank", "title", "score"]
    tuned = index.embed_and_search("keeper paints", rows=1, search_mode="keywords_required", mm="strict", vector_topk=500)
    assert "keeper" in tuned.first()["page_content"]
    prompt = index.ai_answer("what is rope spun from", rag_docs=1, rag_words=3).first()
    assert prompt["context"].endswith(" - Rope is spun - ") and "what is rope spun from" in prompt["instruction"]
    reply = index.ai_answer("keeper", filter={"section": "people"}, answer_model=lambda rows: [" yes " for _ in rows]).first()
    assert reply["answer"] == "yes" and "keeper" in reply["context"]
    own = spark.createDataFrame([(0, "q", "mine")], "query_id long, query_text string, context string")
    assert index.ai_answer(own).first()["context"] == "mine"
    # same id again replaces
    index.add_texts(["The keeper sleeps"], [{"section": "people"}], [IDS[1]])
    assert index.documents().count() == 4
    assert index.get_by_ids([IDS[1]]).first()["page_content"] == "The keeper sleeps"
    # deletes
    index.delete([IDS[3], index.keys[0]])
    assert index.get_by_ids([IDS[3], IDS[0]]).count() == 0
    index.delete(query="meta['section'] = 'people'")
    assert index.get_by_ids([IDS[1]]).count() == 0
    with pytest.raises(ValueError):
        index.delete()
    index.delete(delete_all=True)
    assert index.documents().count() == 0


def test_missing_index_and_random_ids(spark, tmp_path):
    with pytest.raises(ValueError, match="does not exist"):
        SearchIndex(spark, str(tmp_path), "nowhere")
    store = SearchIndex.from_texts(spark, str(tmp_path), ["a b", "c d"], index="made")
    assert store.add_texts([]) == []
    keys = store.add_texts(["same", "same"])
    assert store.get_by_ids(keys).count() == 2 and len(set(keys)) == 2
    with pytest.raises(ValueError):
        store.add_texts(["a"], [{}, {}])


def test_add_table_reports_rejected_rows(spark, tmp_path):
    store = SearchIndex(spark, str(tmp_path), "table", create_if_missing=True)
    rows = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), (None, "c", 3), ("2", None, 4)], "id string, text string, n int")
    rejected = store.add_table(rows, metadata_cols=["n"], order_col="n")
    assert sorted(r["reason"] for r in rejected.collect()) == ["missing_id", "missing_text", "replaced_in_batch"]
    assert [r["text"] for r in store.documents().collect()] == ["b"]


def plain(spark, rows):
    return build_documents(spark.createDataFrame(rows, "id string, text string"), "idx")


def texts(store):
    return {r["ext_id"]: r["text"] for r in store.read().collect()}


def test_store_segments(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), "idx").create()
    assert store.read().count() == 0
    store.replace(plain(spark, [("a", "1"), ("b", "1"), ("c", "1")]))
    hidden = store.upsert(plain(spark, [("b", "2"), ("d", "2")]), visible=False)
    assert texts(store) == {"a": "1", "b": "1", "c": "1"}
    store.make_visible(hidden)
    assert texts(store) == {"a": "1", "b": "2", "c": "1", "d": "2"}
    store.delete(query=F.col("text") == "2")
    assert texts(store) == {"a": "1", "c": "1"}
    store.upsert(plain(spark, [("b", "3")]))
    assert texts(store) == {"a": "1", "b": "3", "c": "1"}
    # A replayed segment is written once more, not added.
    for text in ("4", "4"):
        store.upsert(plain(spark, [("c", text)]), segment="batch-1")
    assert len([r for r in store.manifest() if r["segment"] == "batch-1"]) == 1
    store.compact()
    assert texts(store) == {"a": "1", "b": "3", "c": "4"}
    IndexStore(spark, str(tmp_path), "other").create()
    assert list_indexes(spark, str(tmp_path)) == ["idx", "other"]
    counts = {r["index"]: (r["n_docs"], r["n_vectors"]) for r in describe_indexes(spark, str(tmp_path)).collect()}
    assert counts == {"idx": (3, 0), "other": (0, 0)}
    assert list_indexes(spark, str(tmp_path / "none")) == []


def test_store_without_broadcast(spark, tmp_path, shuffled_joins):
    test_store_segments(spark, tmp_path)


SCHEMA = "id string, text string, n long"


def queue(spark, tmp_path, files):
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "queue" / f"f{i}"))
    return ingest.file_stream(spark, str(tmp_path / "queue" / "*"), SCHEMA)


def build(batch, order):
    return build_documents(batch, "idx", metadata_cols=["n"], seq=order)


def test_stream_to_index(spark, tmp_path):
    files = [[("a", "old", 1), ("b", "b", 2)], [("a", "new", 3), (None, "x", 4)], [("c", None, 5), ("c", "c", 6), ("c", "cc", 7)]]
    store = IndexStore(spark, str(tmp_path / "root"), "idx")
    checkpoint = str(tmp_path / "checkpoint")
    ingest.wait(ingest.start_ingest(store, queue(spark, tmp_path, files), build, checkpoint))
    assert texts(store) == {"a": "new", "b": "b", "c": "cc"}
    jobs = store.jobs()
    assert {(r["state"], r["jobs"], r["processed"], r["success"], r["failed"]) for r in ingest.job_counts(jobs).collect()} == {("completed", 3, 7, 4, 3)}
    # Nothing new: nothing happens. The same batch again: nothing changes.
    stream = ingest.file_stream(spark, str(tmp_path / "queue" / "*"), SCHEMA)
    ingest.wait(ingest.start_ingest(store, stream, build, checkpoint))
    assert store.jobs().count() == 3
    again = spark.createDataFrame(files[0], SCHEMA)
    ingest.ingest_batch(store, build, "ingest-000000000", again)
    assert texts(store) == {"a": "new", "b": "b", "c": "cc"} and store.jobs().count() == 3


def test_stream_failure_and_timeout(spark, tmp_path):
    def broken(batch, order):
        raise RuntimeError("no such model")

    store = IndexStore(spark, str(tmp_path / "root"), "idx")
    running = ingest.start_ingest(store, queue(spark, tmp_path, [[("a", "x", 1)]]), broken, str(tmp_path / "c1"))
    with pytest.raises(Exception, match="no such model"):
        ingest.wait(running)
    assert store.jobs().first()["state"] == "failed"
    stream = ingest.file_stream(spark, str(tmp_path / "queue" / "*"), SCHEMA)
    waiting = ingest.start_ingest(store, stream, build, str(tmp_path / "c2"), "slow", commit="within")
    with pytest.raises(TimeoutError):
        ingest.wait(waiting, timeout=1)
    assert not waiting.isActive


def test_commit_choices():
    assert ingest.trigger_of("now") == {"availableNow": True}
    assert ingest.trigger_of("within") == {"processingTime": "10 seconds"}
    with pytest.raises(ValueError):
        ingest.trigger_of("later")


def test_reader_spans_a_replay(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), "idx").create()
    store.upsert(plain(spark, [("a", "1"), ("b", "1")]), segment="batch-1")
    before = store.read()
    store.upsert(plain(spark, [("a", "2")]), segment="batch-1")
    assert {r["ext_id"]: r["text"] for r in before.collect()} == {"a": "1", "b": "1"}
    assert texts(store) == {"a": "2"}


def test_compaction_keeps_what_is_added_meanwhile(spark, tmp_path, monkeypatch):
    store = IndexStore(spark, str(tmp_path), "idx").create()
    store.upsert(plain(spark, [("a", "1"), ("b", "1")]))
    content = IndexStore._content

    def slow(self, entries):
        rows = content(self, entries)
        if monkeypatch is not None and len(entries) == 2:
            IndexStore(spark, str(tmp_path), "idx").upsert(plain(spark, [("b", "2"), ("c", "2")]))
        return rows

    monkeypatch.setattr(IndexStore, "_content", slow)
    store.compact()
    monkeypatch.setattr(IndexStore, "_content", content)
    assert texts(store) == {"a": "1", "b": "2", "c": "2"}
    store.compact()
    assert texts(store) == {"a": "1", "b": "2", "c": "2"}


def test_rejected_rows_are_reported(spark, tmp_path):
    index = SearchIndex(spark, str(tmp_path), "idx", create_if_missing=True)
    rows = [("1", "first", [1.0, 0.0]), ("1", "second", [0.0, 1.0]), ("1", "third", [1.0, 1.0]), ("2", "short", [1.0]), ("3", "none", None)]
    source = spark.createDataFrame(rows, "id string, text string, v array<double>").coalesce(1)
    rejected = index.add_table(source, "id", "text", embedding_col="v")
    assert sorted((r["id"], r["text"], r["reason"]) for r in rejected.collect()) == [
        ("1", "first", "replaced_in_batch"), ("1", "second", "replaced_in_batch"), ("2", "short", "vector_length"),
    ]
    assert {r["ext_id"]: r["text"] for r in index.documents().collect()} == {"1": "third", "3": "none"}
    with pytest.raises(Exception, match="dimensions"):
        index.similarity_search_by_vector([1.0, 2.0, 3.0]).collect()


def test_context_is_decided_per_query(spark, tmp_path):
    index = SearchIndex.from_texts(spark, str(tmp_path), ["rivers flow to the sea", "bread needs flour"], index="idx", ids=["r", "b"])
    asked = spark.createDataFrame([(0, "what does bread need", None), (1, "q", "mine")], "query_id long, query_text string, context string")
    got = {r["query_id"]: (r["context"], r["instruction"]) for r in index.ai_answer(asked).collect()}
    assert "flour" in got[0][0] and got[0][1] and got[1] == ("mine", None)
