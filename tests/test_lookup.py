import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from rollcall.operators.lookup import are_small, lookup_join


@pytest.fixture
def skewed(spark, tmp_path):
    """A third of the facts on key 7, a third on null; copies; repeated dim ids."""
    path = str(tmp_path / "fact")
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 3 == 1, None).otherwise(n % 50).cast("bigint")
    fact = spark.range(0, 30_000, 1, 6).select((n % 1000).alias("id"), key.alias("key"))
    fact.write.parquet(path)
    dim = spark.range(0, 40).select(n.alias("dim_id"), F.concat(F.lit("L"), n).alias("label"))
    dim = dim.unionAll(dim.filter("dim_id IN (7, 8)").withColumn("label", F.lit("again")))
    return spark.read.parquet(path), dim


def plain(fact, dim):
    return fact.join(dim, fact.key == dim.dim_id, "left").select("id", "key", "label")


def test_small_lookup_is_broadcast(skewed):
    joined = lookup_join(*skewed, "key", "dim_id", small=True)
    assert rows(joined, "id", "key", "label") == rows(plain(*skewed))
    assert "BroadcastHashJoin" in plan_of(joined)


def test_large_lookup_is_shuffled_and_reads_the_facts_once(skewed, conf):
    conf(spark__sql__autoBroadcastJoinThreshold=-1)
    joined = lookup_join(*skewed, "key", "dim_id", small=False)
    assert joined.columns == ["id", "key", "label"]
    assert rows(joined) == rows(plain(*skewed))
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 1


def largest_share(joined):
    sizes = joined.groupBy(F.spark_partition_id()).count()
    return sizes.agg(F.max("count") / F.sum("count")).first()[0]


def test_rows_without_a_key_are_spread(skewed, conf):
    fact, dim = skewed
    conf(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__enabled=False)
    joined = lookup_join(fact.filter("key IS NULL"), dim, "key", "dim_id", small=False)
    assert largest_share(joined) < 0.4


def test_adaptive_execution_splits_other_hot_keys(skewed, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__shuffle__partitions=8,
    )
    joined = lookup_join(*skewed, "key", "dim_id", small=False)
    assert "skew=true" in plan_of(joined) and rows(joined) == rows(plain(*skewed))


def test_size_is_measured_in_rows_and_bytes(spark):
    dim = spark.range(100).select("id", F.lit("x" * 1000).alias("label"))
    few = dim.filter("id < 10")
    assert are_small(dim, few) == [True, True]
    assert are_small(dim, few, max_rows=99) == [False, True]
    assert are_small(few, dim, max_bytes=50_000) == [True, False]
    assert are_small(dim.filter("id < 0"), max_rows=0) == [True]


def test_the_split_is_the_same_when_run_again(skewed, conf):
    """A task that runs again after a loss sends its rows where they went before."""
    conf(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__enabled=False)
    joined = lookup_join(*skewed, "key", "dim_id", small=False)
    placed = joined.withColumn("at", F.spark_partition_id())
    assert rows(placed) == rows(placed)
