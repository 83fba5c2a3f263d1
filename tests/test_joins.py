"""The keyed join on hot keys, against a plain join and by the spread of its rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from veilspark.operators.joins import is_small, keyed_join


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows are copies of one row; a tenth have a null key."""
    rows = spark.range(0, 30_000, numPartitions=16)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 5000)
    value = F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string"))
    left = rows.select(key.alias("k"), value.alias("v"))
    right = spark.range(0, 4000).select(
        (F.col("id") % 3500).alias("k"), F.concat(F.lit("r"), F.col("id")).alias("w")
    )
    return left, right


@pytest.mark.parametrize("small", [0, 1_000_000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_plain_join(sides, how, small):
    left, right = sides
    got = keyed_join(left, right, ["k"], how, small=small)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_two_keys(spark, sides):
    left = sides[0].withColumn("g", F.lit("a"))
    right = sides[1].withColumn("g", F.lit("a"))
    got = keyed_join(left, right, ["g", "k"], small=0)
    assert got.count() == left.join(right, ["g", "k"]).count()


def test_refuses_joins_that_keep_right_rows(sides):
    with pytest.raises(ValueError):
        keyed_join(*sides, ["k"], "full")


def test_is_small_counts_rows(spark):
    assert is_small(spark.range(10), 10)
    assert not is_small(spark.range(11), 10)


def test_only_counted_sides_are_broadcast(spark, sides):
    left, right = sides

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "rightHint=(strategy=broadcast)" in plan(keyed_join(left, right, ["k"]))
    assert "strategy=broadcast" not in plan(keyed_join(left, right, ["k"], small=100))


def test_wide_rows_are_not_broadcast(spark, sides):
    """A side is small by its bytes too: few rows of long texts or arrays are not."""
    long = spark.range(200).selectExpr("id k", "repeat('x', 200000) w")
    many = spark.range(200).selectExpr("id k", "transform(sequence(1, 30000), x -> 'name') w")
    assert is_small(spark.range(200)) and not is_small(long) and not is_small(many)
    plan = keyed_join(sides[0], long, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_maps_can_be_carried(spark):
    left = spark.range(9000).selectExpr("if(id % 3 = 0, 7, id) k", "map('a', id) m", "id")
    right = spark.range(5000).selectExpr("id k", "id w")
    got = keyed_join(left, right, ["k"], small=0)
    assert got.count() == left.join(right, ["k"]).count()


@pytest.mark.parametrize("heavy", ["left", "right"])
def test_heavy_keys_are_cut_by_adaptive_execution(spark, heavy):
    """Either side may own the heavy key; its partition is read by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        many = spark.range(0, 60_000, numPartitions=16).selectExpr("if(id % 3 = 0, 7, id) k", "uuid() v")
        few = spark.range(0, 60_000, numPartitions=8).selectExpr("id k", "id w")
        joined = keyed_join(*((many, few) if heavy == "left" else (few, many)), ["k"], small=0)
        joined.write.format("noop").mode("overwrite").save()
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("k") == 7).alias("n"))
        assert tasks.filter("n > 0").count() > 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
