"""Plan shapes that matter at scale."""

import pathlib
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from omnimart.operators.dedup import keep_latest
from omnimart.operators.keysets import left_join_many
from omnimart.operators.ranking import tile_scores
from omnimart.plans import core, staging
from omnimart.plans.catalogue import AS_OF, Model
from omnimart.streaming import events
from omnimart.sources.star import StarSource

FOLDER = pathlib.Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not FOLDER.exists(), reason="needs the given tables")


@pytest.fixture
def model(spark):
    return Model(StarSource(spark, str(FOLDER)))


def scan_schema(text, table):
    found = re.search(rf"{table}\.parquet\].*?ReadSchema: struct<(.*?)>\n", text, re.S)
    return {c.split(":")[0] for c in found.group(1).split(",")}


@needs_data
def test_period_filter_reaches_the_scan(model, plan):
    text = plan(model.selected("sales_amount"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate,2001-10-06T06:00", text)


@needs_data
def test_stock_query_reads_few_columns(model, plan):
    columns = scan_schema(plan(model.available()), "lineitem")
    assert "l_discount" not in columns and "l_tax" not in columns
    assert columns <= {
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    }


@needs_data
@pytest.mark.parametrize(
    "build",
    [
        lambda m: m.sales(),
        lambda m: m.available(),
        lambda m: m.events(),
        lambda m: m.customers(),
    ],
)
def test_no_cross_join_and_no_python(model, plan, build):
    text = plan(build(model))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert node not in text


def test_latest_row_is_picked_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 9).alias("k"), F.timestamp_seconds("id").alias("t"))
    text = plan(keep_latest(df, "k", "t"))
    tree = text.split("\n\n")[0]
    limits = [i for i, line in enumerate(tree.splitlines()) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(tree.splitlines()) if "Exchange" in line)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_hot_copies_leave_each_task_once(spark):
    """A third of all rows share one key; after the shuffle few of them are left."""
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds("id").alias("t"),
    )
    result = keep_latest(df, "k", "t")
    assert result.count() == 20_001
    assert result.filter("k = 0").first()["t"] == datetime.fromtimestamp(29_997)


def test_tiles_need_no_single_partition(spark, plan):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("v"))
    text = plan(tile_scores(df, "k", {"s": F.col("v")}))
    assert "SinglePartition" not in text and "Exchange" not in text


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def hot_rows(spark):
    """Half of the rows share one key."""
    return spark.range(0, 200_000, 1, 8).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias(
            "source_customer_id"
        ),
    )


def executed_plan(df):
    # Writing runs the query itself, so its adaptive plan becomes final.
    df._jdf.queryExecution().executedPlan().execute().count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_is_split_by_the_fact_join(spark, small_skew_limits):
    facts = hot_rows(spark)
    bridge = facts.select("source_customer_id").distinct().withColumn("customer_id", F.lit("C"))
    assert "skew=true" in executed_plan(core._resolve(facts, bridge))


def test_hot_customer_is_split_by_the_enrichment(spark, small_skew_limits):
    facts = hot_rows(spark)
    bridge = facts.select("source_customer_id").distinct().withColumn("customer_id", F.lit("C"))
    assert "skew=true" in executed_plan(events.enrich(facts, bridge))


def test_hot_payment_key_is_split(spark, small_skew_limits):
    right = hot_rows(spark)
    left = spark.createDataFrame([("hot", 1), ("none", 2)], "source_customer_id string, v int")
    joined = left_join_many(left, right, "source_customer_id")
    assert "skew=true" in executed_plan(joined)
    counts = {r["source_customer_id"]: r["count"] for r in joined.groupBy("source_customer_id").count().collect()}
    assert counts == {"hot": 100_000, "none": 1}


@needs_data
def test_bound_before_deduplication_keeps_the_result(spark):
    """Applying the period before or after keeping the latest row gives the same rows."""
    source = StarSource(spark, str(FOLDER))
    since = datetime(2001, 9, 1)
    early = staging.stg_orders(source, since)
    late = staging.stg_orders(source).filter(F.col("ordered_at") >= F.lit("2001-09-01").cast("timestamp"))
    assert sorted(early.collect()) == sorted(late.collect())
    assert AS_OF > since
