"""What Spark will run: pushed filters, pruned columns, no products, no single-task windows."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL
from shelfwise.operators import evaluate, ids, relational as rel
from shelfwise.plans.catalog import ORACLES, QUERIES
from shelfwise.plans.registry import Tables

# Fits and searches run jobs while the plan is built; their remaining plans are small tables.
LAZY = sorted(ORACLES)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_products_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in text, f"{name}: {node}"


def single_tasks(text: str) -> int:
    return len(re.findall(r"Exchange SinglePartition", text))


@pytest.mark.parametrize("name", ["id_mapping", "user_item_vector", "topk_per_group", "item_item_cosine", "rec_neighbourhood", "tfidf"])
def test_no_single_task_windows(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search(r"Window.*\n.*Sort.*\n.*Exchange SinglePartition", text), name


def test_index_form_has_no_single_task(spark):
    pairs = rel.order_pairs(Tables(spark, SMALL).orders, Tables(spark, SMALL).lineitem)
    assert single_tasks(plan(pairs.select("u", F.dense_rank().over(Window.orderBy("u"))))) == 1
    assert single_tasks(plan(ids.dense_index(pairs, "u", "ix"))) == 0


def test_pushdown_and_pruning(spark):
    text = plan(QUERIES["filter_eq"](spark, SMALL))
    assert "EqualTo(l_returnflag,R)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in text
    text = plan(QUERIES["copurchase_top10"](spark, SMALL))
    assert "TakeOrderedAndProject" in text
    # The target's items are a small known table: their test runs at the lineitem scan.
    assert text.index("HashAggregate(keys=[u") < text.index("LeftSemi") and "Not(EqualTo(o_custkey,42))" in text
    assert "l_extendedprice" not in text


def test_group_limit_before_shuffle(spark):
    text = plan(QUERIES["topk_per_group"](spark, SMALL))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_xml_is_parsed_once(spark):
    text = plan(QUERIES["telemetry_parse"](spark, SMALL))
    assert text.count("from_xml(") == 1


def test_two_passes_share_one_shuffle(spark):
    df = QUERIES["tfidf"](spark, SMALL)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_texts_are_tokenized_once(spark):
    assert plan(QUERIES["tokenize"](spark, SMALL)).count("UDF(text") == 1


def test_hot_keys_are_split(spark):
    """With thresholds scaled to the test table, Spark splits the partition of a hot user in a join."""
    hot = spark.range(200_000).selectExpr("if(id % 3 = 0, 7, id % 5000) AS u", "id AS i")
    users = spark.range(5000).selectExpr("id AS u", "id * 2 AS p")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = hot.repartition(40, "i").join(users, "u").groupBy("i").sum("p")
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["count_vectorizer", "tfidf"])
def test_document_terms_are_not_sorted(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    assert not re.search(r"(?m)^[ :+\-*()\d]*Sort \[term", text)


def test_cross_validation_reads_vectors_only(spark, monkeypatch):
    """No fit tokenizes texts again."""
    seen, search = [], evaluate.cross_validate
    monkeypatch.setattr(evaluate, "cross_validate", lambda df, *args, **named: seen.append(df.columns) or search(df, *args, **named))
    QUERIES["cross_validate"](spark, SMALL)
    assert seen == [["label", "fold", "features"]] * 3
