"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import public_tokenizers
import pytest

import corpus_pipeline
from glimmerdex.llm import archive, bpe, decontaminate, forest, licenses, pii, quality, secrets, simhash, token_file

CLASH = "score double, fp long, statistics string, text_hash long, spans string, pii_spans string, blob string, ids string, part int, missing int, utf8 string, row_key string"
ROWS = [
    (1, None, None, None),
    (2, "", "en", "s"),
    (3, "x" * 300000, "en", "s"),
    (4, "word " * 60000, "en", None),
    (5, "the same text of a few words, twice", "en", "s"),
    (5, "the same text of a few words, twice", "en", "s"),
    (5, "another text under the same number", None, "s"),
    (None, "a text without a number at me@you.org", "en", "s"),
    (None, "a text without a number at me@you.org", "en", "s"),
    (-9, "negative numbers are numbers; token = abcdefgh12", "en", "s"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, source, None if t is None else len(t), *[None] * 12) for i, t, lang, source in ROWS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}").repartition(3)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables for the stages that read one beside the documents."""
    where = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (5, 1, None), (5, 0, 1), (None, 1, 0), (77, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(0, None), (1, ""), (2, "another text under the same number"), (None, "of no use")], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def run_all(spark, docs, folder, tmp_path):
    words, bytes_ = public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.path(token_file.VOCABULARY)
    token_file.write_tokens(docs, f"{tmp_path}/orc", bytes_)
    stats, column = quality.measured(docs)
    stats = stats.withColumnRenamed("statistics", "theirs").withColumnRenamed(column, "statistics") if column != "statistics" else stats
    return {
        "tokens": token_file.checksums(token_file.read_tokens(spark, f"{tmp_path}/orc")),
        "simhash": simhash.near_duplicates(docs),
        "quality": quality.scored(stats, quality.fit(stats, quality.labels_of(spark, folder)), "statistics", "score_"),
        "pii": pii.spans(docs),
        "sanitised": pii.sanitise(docs),
        "secrets": secrets.scan(docs, f"{tmp_path}/ledger"),
        "bpe": bpe.encode(docs, words),
        "licences": licenses.scan(docs, path_col="source"),
    }


def test_every_row_has_a_result(spark, docs, folder, tmp_path):
    for name, result in run_all(spark, docs, folder, tmp_path).items():
        assert result.count() == len(ROWS), name


def test_empty_tables(spark, docs, folder, tmp_path):
    empty = docs.limit(0)
    for name, result in run_all(spark, empty, folder, tmp_path).items():
        assert result.count() == 0, name
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.nearest(vectors, lambda i: i % 50 == 0).count() == 0
    arcs = archive.written(archive.pages_to_arc(spark.createDataFrame([], "page_id long, url string, html string")), "arc")
    archive.write(arcs, f"{tmp_path}/warc")
    assert archive.resolved(archive.read(spark, f"{tmp_path}/warc")).count() == 0


def test_overlaps_of_odd_rows(spark, docs, folder):
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(5, 2)]


def test_groups_of_odd_rows(docs):
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert [c for i, c in got if i == 5] == [5, 5, 5] and [c for i, c in got if i is None] == [None, None]
    assert {c for i, c in got if i in (1, 2)} == {1}  # null and empty texts share fingerprint zero


def test_stages_keep_the_columns_of_documents(spark, docs, folder):
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, table, folder)
            assert kept.columns == docs.columns, name
            assert kept.count() <= len(ROWS)


def test_one_document_of_each_group_stays(spark, docs, folder):
    kept = corpus_pipeline.near_duplicates(spark, docs, folder).collect()
    texts = [(r["doc_id"], r["text"]) for r in kept]
    assert len(texts) == len(set(texts)) == 7
    assert {t for _, t in texts if t} == {t for _, t, *_ in ROWS if t}
    assert sorted(i for i, t in texts if not t) == [1]


def test_contaminated_documents_go(spark, docs, folder):
    kept = corpus_pipeline.decontaminated(spark, docs, folder).collect()
    assert len(kept) == len(ROWS) - 1 and "another text under the same number" not in [r["text"] for r in kept]


def test_personal_data_is_replaced(spark, docs, folder):
    kept = corpus_pipeline.without_personal_data(spark, docs, folder).collect()
    texts = [r["text"] for r in kept]
    assert texts.count("a text without a number at <EMAIL>") == 2 and texts.count(None) == 1
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in kept)
