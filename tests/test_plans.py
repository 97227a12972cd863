"""The plans behind the results: what is shuffled, pushed down, broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from glimmerdex.operators import filters, lexical, vector
from glimmerdex.plans import inputs as I
from glimmerdex.plans import sizing
from glimmerdex.plans.catalog import QUERIES
from glimmerdex.sources.index_store import publish_lexical

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|RoundRobin\w+|SinglePartition)", plan)


EAGER = {"stream_ingest", "stream_upsert_replay", "ingest_status", "index_list", "index_write"}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(filters.apply(I.documents(spark, SF), {"lang": "en"}, I.PROMOTED).select("doc_key"))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(lang,en\)", plan)
    assert re.search(r"ReadSchema: struct<doc_id:bigint,lang:string>", plan)


def test_vector_plans_do_not_read_texts(spark):
    plan = plan_of(vector.knn_search(I.vectors(spark, SF), I.vector_queries(spark, SF), 10))
    assert "text:string" not in plan
    assert "WindowGroupLimit" in plan and len(exchanges(plan)) == 1


def test_documents_are_built_without_a_shuffle(spark):
    assert exchanges(plan_of(I.documents(spark, SF))) == []


def scoring_exchanges(df) -> list[str]:
    """Exchanges of the scoring branch: what lies above and below the broadcasts is left out."""
    lines = plan_of(df).splitlines()
    kept, skipped = [], None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth > skipped:
            continue
        skipped = depth if "BroadcastExchange" in line else None
        if skipped is None:
            kept.append(line)
    return exchanges("\n".join(kept))


def test_clustered_search_shuffles_once_before_the_top_k(spark):
    asked = I.queries(spark, SF)
    df = lexical.lexical_search(lexical.clustered(I.documents(spark, SF)), asked, 10)
    assert len(scoring_exchanges(df)) == 2  # documents by key, result rows by query
    assert "WindowGroupLimit" in plan_of(df)


def test_published_search_shuffles_result_rows_only(spark, tmp_path):
    docs = I.documents(spark, SF).drop("embedding", "meta")
    index = publish_lexical(docs, str(tmp_path / "p"), "published_plan", ["title", "text"], 4)
    df = lexical.lexical_search(index, I.queries(spark, SF), 10, {"title": 100.0, "text": 1.0})
    found = scoring_exchanges(df)
    assert len(found) == 1 and "query_id" in found[0]
    some = lexical.lexical_search(index, I.queries(spark, SF), 10, {"text": 1.0}, "lang = 'en'")
    assert sum("doc_key" in e for e in scoring_exchanges(some)) == 0


@pytest.mark.parametrize("where", [None, "lang = 'en'"])
def test_no_text_is_shuffled_beyond_a_few_splits(spark, where):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        docs = I.documents(spark, SF)
        assert not sizing.few_splits(docs)
        plan = lexical.lexical_search(docs, I.queries(spark, SF), 10, where=where)._jdf.queryExecution()
        lines = plan.optimizedPlan().toString().splitlines() + plan_of(lexical.lexical_search(docs, I.queries(spark, SF), 10, where=where)).splitlines()
        shuffled = [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Repartition" in line or re.search(r"Exchange hash", line)]
        assert shuffled and not any(re.search(r"\b(text|description|terms_\w+)#", line) for line in shuffled)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_splits_are_measured_in_bytes(spark, tmp_path):
    spark.range(1000).repartition(40).write.parquet(str(tmp_path / "many"))
    assert sizing.few_splits(spark.read.parquet(str(tmp_path / "many")))  # many files, little to ship


def test_sizes_are_counted(spark):
    rows = spark.range(10).select(F.lit("abc").alias("s"), F.array(F.lit(1.0), F.lit(2.0)).alias("a"), F.create_map(F.lit("k"), F.lit("v")).alias("m"))
    n, size = sizing.measure(rows)
    assert n == 10 and size >= 10 * (3 + 16 + 5)
    assert sizing.measure(rows.limit(0)) == (0, 0)
    assert sizing.is_small(rows)


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert sizing.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def shuffled_rows(df) -> int:
    """Rows written by all shuffles of the executed plan, hot partitions found split."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_large_look_up_sides_are_shuffled_once(spark, shuffled_joins, how):
    """A third of the rows have one key; neither they nor the side are repeated for it."""
    rows = spark.range(60_000).selectExpr("IF(id % 3 = 0, 7, id) AS key", "id AS row").repartition(8)
    side = spark.range(50_000).selectExpr("id AS key", "id * 2 AS looked_up")
    tight = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in tight}
    for k, v in tight.items():
        spark.conf.set(k, v)
    try:
        joined = sizing.keyed_join(rows, side, ["key"], "row", how)
        assert shuffled_rows(joined) <= 60_000 + 60_000 + 1.2 * 50_000  # rows are dealt out once before
        assert "skew=true" in plan_of(joined)
        assert joined.count() == {"inner": 53_333, "left": 60_000, "left_semi": 53_333, "left_anti": 6_667}[how]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_salts_stand_in_for_adaptive_execution(spark, shuffled_joins):
    rows, side = spark.range(1000).selectExpr("id % 10 AS key", "id AS row"), spark.range(9).selectExpr("id AS key", "id * 2 AS looked_up")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = sizing.keyed_join(rows, side, ["key"], "row", "left")
        assert "_salt" in joined._jdf.queryExecution().toString()
        assert joined.count() == 1000 and joined.filter("looked_up IS NULL").count() == 100
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
