"""Physical plans: what is pruned, how groups are aggregated, what happens to a hot key."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from panelloom.bindings.panels import MONTHLY
from panelloom.operators import groups, joins
from panelloom.operators.splitting import fold_summary, temporal_split
from panelloom.plans.annual_panel import yearly_rollup


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def forced_sort_merge(spark):
    """No broadcast, and partitions count as skewed from a few kilobytes on."""
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    ):
        yield


def _hot(spark, n=60_000):
    """60 % of the rows share one key."""
    key = F.when(F.col("id") % 10 < 6, F.lit(7)).otherwise(F.col("id") % 1000)
    return spark.range(0, n, 1, 8).select("id", key.alias("k"), F.xxhash64("id").cast("string").alias("payload"))


def _assert_complete(out, n=60_000):
    rows = out.select(F.count("*"), F.count("v"), F.count_distinct("id")).collect()[0]
    assert tuple(rows) == (n, n, n)


def _runs_skewed(df):
    df.collect()  # the plan of ``df`` itself becomes final
    return "skew=true" in plan(df)


def test_lookup_join_splits_a_hot_key(spark, forced_sort_merge):
    right = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = joins.join_many_to_one(_hot(spark), right, ["k"])
    assert _runs_skewed(out)
    _assert_complete(out)


def test_group_values_split_a_hot_group(spark, forced_sort_merge):
    out = groups.with_group_values(_hot(spark), ["k"], {"v": F.count("*")})
    assert _runs_skewed(out)
    _assert_complete(out)


def test_key_filter_splits_a_hot_key(spark, forced_sort_merge):
    valid = spark.range(1000).select(F.col("id").alias("k"))
    out = joins.key_filter(_hot(spark), valid, ["k"])
    assert _runs_skewed(out)
    assert out.count() == 60_000


def test_small_lookup_is_broadcast_by_size(spark):
    right = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert "BroadcastHashJoin" in plan(joins.join_many_to_one(_hot(spark), right, ["k"]))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="100"):
        assert "SortMergeJoin" in plan(joins.join_many_to_one(_hot(spark), right, ["k"]))


def test_rollup_totals_use_a_hash_aggregate(spark):
    schema = "l_suppkey long, year int, month int, period_end date, price double, sold double, listed double, discount double, stock double, flag string"
    yearly = yearly_rollup(spark.createDataFrame([], schema), MONTHLY)
    assert "SortAggregate" not in plan(yearly.drop("first_flag"))
    assert plan(yearly.drop("first_flag")).count("Exchange hashpartitioning") == 1


def test_key_check_of_numbers_stays_a_hash_aggregate(spark):
    numbers = spark.range(5).select(F.col("id").alias("k"), F.rand(1).alias("v"))
    assert "SortAggregate" not in plan(joins.checked_unique(numbers, ["k"]))
    texts = numbers.withColumn("t", F.col("k").cast("string"))
    assert joins.checked_unique(texts, ["k"]).columns == ["k", "v", "t"]


def test_split_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id AS z", "cast(2010 + id AS int) AS year", "id AS unused").write.parquet(path)
    text = plan(temporal_split(spark.read.parquet(path), "year", (2012, 2014), 2015).select("z", "split"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(year,2012\)", text)
    assert "unused" not in text


def test_folds_need_one_exchange_of_entities(spark):
    df = spark.createDataFrame([("a", 2012)], "z string, year int")
    text = plan(fold_summary(df, "z", "year", range(2013, 2019)))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
