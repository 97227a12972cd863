"""Concurrent changes of an index: no order of their steps loses a document, and look-ups open few files."""

import itertools
import threading

import pytest
from pyspark.sql import functions as F

from glimmerdex.operators.documents import build_documents
from glimmerdex.sources import index_store, manifest
from glimmerdex.sources.commits import CommitLog, Conflict, Folder
from glimmerdex.sources.index_store import IndexStore, describe_indexes, list_indexes, publish_each
from glimmerdex.store import SearchIndex


class Memory:
    """A folder of files that are made once."""

    def __init__(self):
        self.files = {}

    def names(self):
        return list(self.files)

    def read(self, name):
        return self.files[name]

    def create(self, name, text):
        if name in self.files:
            return False
        self.files[name] = text
        return True


class Model:
    """An index whose segments hold {key: text or None}, changed in two steps as the store does it."""

    def __init__(self):
        self.log, self.rows = CommitLog(Memory()), {}
        self.log.commit(lambda s: manifest.replaced(s, self.segment("base", {"a": "0", "b": "0"})))

    def segment(self, kind, rows, name=None):
        path = f"p{len(self.rows)}"
        self.rows[path] = rows
        return {"segment": name or path, "named": name is not None, "origin": None, "kind": kind, "path": path}

    def content(self):
        out = {}
        for s in self.log.latest()[1]["segments"]:
            out |= self.rows[s["path"]]
        return {k: v for k, v in out.items() if v is not None}

    def prepare(self, what):
        if what == "compact":
            paths = [s["path"] for s in self.log.latest()[1]["segments"]]
            base = self.segment("base", self.content())
            return lambda s: manifest.compacted(s, base, paths)
        if what == "delete_all":
            base = self.segment("base", {})
            return lambda s: manifest.replaced(s, base)
        new = self.segment("upsert", what[1], what[0])
        return lambda s: manifest.added(s, new)


CHANGES = {"compact 1": "compact", "compact 2": "compact", "upsert": (None, {"a": "1", "c": "1"}), "delete_all": "delete_all"}


def orders(names):
    """Every order of the two steps of each change."""
    steps = [n for n in names for _ in range(2)]
    seen = set()
    for order in itertools.permutations(range(len(steps))):
        named = tuple(steps[i] for i in order)
        if named not in seen:
            seen.add(named)
            yield named


def test_every_order_of_two_compactions_an_upsert_and_a_removal_of_everything():
    count = 0
    for order in orders(CHANGES):
        model, made, want = Model(), {}, {"a": "0", "b": "0"}
        for name in order:
            if name not in made:
                made[name] = model.prepare(CHANGES[name])
                continue
            try:
                model.log.commit(made[name])
            except Conflict:
                assert name.startswith("compact")
            if name == "upsert":
                want |= CHANGES[name][1]
            elif name == "delete_all":
                want = {}
            assert model.content() == want, order  # no compaction changes what is read
        count += 1
    assert count == 2520


def test_a_compaction_folds_when_nothing_is_in_its_way():
    model = Model()
    model.log.commit(model.prepare((None, {"c": "1"})))
    fold = model.prepare("compact")
    model.log.commit(model.prepare((None, {"d": "2"})))
    model.log.commit(fold)
    segments = model.log.latest()[1]["segments"]
    assert [s["kind"] for s in segments] == ["base", "upsert"] and len({s["position"] for s in segments}) == 2
    assert model.content() == {"a": "0", "b": "0", "c": "1", "d": "2"}


def test_replays_of_named_segments():
    model = Model()
    batch = lambda n, rows, origin="x": model.log.commit(lambda s: manifest.added(s, model.segment("upsert", rows, f"job-{n:03d}") | {"origin": origin}))
    batch(7, {"a": "7"})
    batch(8, {"a": "8"})
    batch(7, {"a": "7"})  # in its old place
    assert model.content()["a"] == "8" and len(model.log.latest()[1]["segments"]) == 3
    model.log.commit(model.prepare("compact"))
    model.log.commit(model.prepare((None, {"a": "new"})))
    batch(8, {"a": "8"})  # part of the base
    assert model.content()["a"] == "new"
    batch(8, {"a": "other"}, origin="y")  # another series of the same name
    assert model.content()["a"] == "other"
    batch(9, {"a": "9"})
    assert model.content()["a"] == "9"


def test_one_writer_makes_a_version(spark, tmp_path):
    logs = [CommitLog(Folder(spark, f"{tmp_path}/log")) for _ in range(6)]
    assert logs[0].latest() == (-1, None)
    wins, gate = [], threading.Barrier(6)

    def write(k):
        gate.wait()
        for n in range(5):
            logs[k].commit(lambda s: {"seen": [*(s or {"seen": []})["seen"], (k, n)]})
            wins.append((k, n))

    threads = [threading.Thread(target=write, args=(k,)) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    version, state = logs[0].latest()
    assert version == 29 and sorted(map(tuple, state["seen"])) == sorted(wins) and len(wins) == 30
    assert logs[1].folder.create(f"{version:020d}.json", "{}") is False
    assert len(logs[0].folder.names()) == 30  # nothing temporary is left


def plain(spark, rows):
    return build_documents(spark.createDataFrame(rows, "id string, text string"), "idx")


def texts(store):
    return {r["ext_id"]: r["text"] for r in store.read().collect()}


def test_overlapping_compactions_keep_an_upsert(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), "idx").create()
    store.replace(plain(spark, [("1", "one"), ("2", "two")]))
    early = store.prepare_compaction()
    store.upsert(plain(spark, [("3", "three")]))
    assert store.compact() and len(store.manifest()) == 1
    with pytest.raises(Conflict):
        store.make_visible(early)
    assert texts(store) == {"1": "one", "2": "two", "3": "three"}
    late = store.prepare_compaction()
    store.delete(delete_all=True)
    with pytest.raises(Conflict):
        store.make_visible(late)
    assert texts(store) == {}


def test_upserts_at_once_have_positions_of_their_own(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), "idx").create()
    hidden = [store.upsert(plain(spark, [("k", str(i)), (f"own{i}", "x")]), visible=False) for i in range(3)]
    threads = [threading.Thread(target=store.make_visible, args=(h,)) for h in hidden]
    [t.start() for t in threads]
    [t.join() for t in threads]
    segments = store.manifest()
    assert len({s["position"] for s in segments}) == len(segments) == 4
    got = texts(store)
    last = next(i for i, h in enumerate(hidden) if h["entry"]["path"] == segments[-1]["path"])
    assert got["k"] == str(last) and set(got) == {"k", "own0", "own1", "own2"}


def test_a_removal_sees_what_was_added_meanwhile(spark, tmp_path, monkeypatch):
    store = IndexStore(spark, str(tmp_path), "idx").create()
    store.upsert(plain(spark, [("a", "bad"), ("b", "good")]))
    matching, added = IndexStore._matching, []

    def slow(self, *given):
        keys = matching(self, *given)
        if not added:
            added.append(IndexStore(spark, str(tmp_path), "idx").upsert(plain(spark, [("c", "bad"), ("d", "good")])))
        return keys

    monkeypatch.setattr(IndexStore, "_matching", slow)
    store.delete(query=F.col("text") == "bad")
    assert texts(store) == {"b": "good", "d": "good"}


@pytest.fixture
def sketched(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "SKETCH_ROWS", 50)
    index = SearchIndex(spark, str(tmp_path), "idx", create_if_missing=True)
    rows = [(f"id{i}", f"text {i}") for i in range(4000)]
    index.store.replace(plain(spark, rows).repartition(40, "doc_key"))
    index.store.upsert(plain(spark, [(f"id{i}", f"changed {i}") for i in range(100, 300)]).repartition(2, "doc_key"))
    index.store.upsert(plain(spark, [("id5", "small change")]))
    index.store.delete(spark.createDataFrame([("id6",)], "id string"))
    return index


def test_look_ups_open_the_files_that_may_hold_an_id(spark, sketched):
    store = sketched.store
    every = len(store.read().inputFiles())
    assert every > 42
    keys = {r["ext_id"]: r["doc_key"] for r in store.read().select("ext_id", "doc_key").collect()}
    asked = ["id7", keys["id150"], "id5", "id6", "nowhere", "id7"]
    opened = store.read_holding(asked).inputFiles()
    assert len(opened) <= 12 < every
    got = [(r["pos"], r["page_content"]) for r in sketched.get_by_ids(asked).collect()]
    assert got == [(0, "text 7"), (1, "changed 150"), (2, "small change"), (5, "text 7")]
    assert {r["text"] for r in store.read_holding([f"id{i}" for i in range(0, 4000, 20)]).collect()} >= {"text 0", "changed 120", "text 3980"}
    assert store.read_holding([]).count() == 0


def test_removals_open_few_files_and_a_replaced_id_is_not_found(spark, sketched, monkeypatch):
    store, seen = sketched.store, []
    content = IndexStore._content
    monkeypatch.setattr(IndexStore, "_content", lambda self, *a: seen.append(rows := content(self, *a)) or rows)
    store.delete(spark.createDataFrame([("id8",), ("id120",)], "id string"))
    assert seen and all(len(rows.inputFiles()) <= 10 for rows in seen)
    monkeypatch.setattr(IndexStore, "_content", content)
    left = texts(store)
    assert len(left) == 4000 - 3 and "id8" not in left and "id120" not in left
    # the document of id9 gets another original id under its old key
    moved = store.read().filter("ext_id = 'id9'").withColumn("ext_id", F.lit("renamed"))
    store.upsert(moved)
    assert sketched.get_by_ids(["id9"]).count() == 0
    assert [r["page_content"] for r in sketched.get_by_ids(["renamed"]).collect()] == ["text 9"]
    assert store.compact() and len(store.read().inputFiles()) == len(spark.read.parquet(store.manifest()[0]["path"]).inputFiles())
    assert sketched.get_by_ids(["id9"]).count() == 0 and sketched.get_by_ids(["renamed", "id10"]).count() == 2


def test_many_ids_scan_the_index(spark, sketched, monkeypatch):
    monkeypatch.setattr(index_store, "NAMES_ASKED", 3)
    asked = [f"id{i}" for i in range(10)]
    assert len(sketched.store.read_holding(asked).inputFiles()) > 40
    assert sketched.get_by_ids(asked).count() == 9
    sketched.store.delete(spark.createDataFrame([(i,) for i in asked], "id string"))
    assert not set(asked) & set(texts(sketched.store))


def test_indexes_of_one_table(spark, tmp_path):
    rows = [(str(i), f"text {i}", lang) for i, lang in enumerate(["en", "de/at", "en", None, "ü %"])]
    source = spark.createDataFrame(rows, "id string, text string, lang string")
    documents = build_documents(source, F.col("lang"), promote=("lang",))
    publish_each(documents, str(tmp_path), "lang")
    counts = lambda: {r["index"]: (r["n_docs"], r["n_vectors"]) for r in describe_indexes(spark, str(tmp_path)).collect()}
    assert counts() == {"en": (2, 0), "ü %": (1, 0)} | {k: v for k, v in counts().items() if k not in ("en", "ü %")}
    store = IndexStore(spark, str(tmp_path), "en")
    assert texts(store) == {"0": "text 0", "2": "text 2"}
    assert all(r["uri"].endswith(f"/en/{r['ext_id']}") for r in store.read().collect())
    store.upsert(plain(spark, [("9", "new")]))
    store.delete(query="ext_id = '0'")
    assert counts()["en"] == (2, 0) and "en" in list_indexes(spark, str(tmp_path))


def test_searches_use_published_tables_while_they_are_current(spark, tmp_path, monkeypatch):
    words = "red green blue cat dog bird runs sleeps sings fast slow rare".split()
    made = [(f"d{i}", " ".join(words[(i * k) % 12] for k in range(1, 3 + i % 7))) for i in range(60)]
    index = SearchIndex.from_texts(spark, str(tmp_path), [t for _, t in made], index="idx", ids=[i for i, _ in made])
    asked = ["cat dog", "fast red bird", "rare", "nothing here", ""]
    kinds = [{"lexical": True}, {"hybrid": True}, {"lexical": True, "filter": "ext_id < 'd3'"}]
    rows = lambda: [sorted(map(tuple, index.similarity_search_with_score(asked, 5, **kind).select("query_id", "rank", "doc_key", "score").collect())) for kind in kinds]
    before = rows()
    index.publish()
    used = []
    published = IndexStore.published
    monkeypatch.setattr(IndexStore, "published", lambda self, fields: used.append(published(self, fields)) or used[-1])
    assert rows() == before and len(used) == 3 and all(used)
    index.add_texts(["rare rare rare"], ids=["new"])
    assert rows() != before and used[-1] is None  # the tables are behind
    index.publish()
    assert [r["page_content"] for r in index.similarity_search("rare", 1, lexical=True).collect()] and used[-1] is not None
