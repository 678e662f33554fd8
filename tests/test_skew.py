"""A key holding a third of all rows: joins split it, aggregates combine it map-side."""

import contextlib
import io

from pyspark.sql import functions as F

from martforge.operators import dedup, marts
from martforge.plans.standins import TEST_STAR


def _final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own adaptive plan to its final form
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_order_key_is_split_in_the_fact_join(spark):
    n = 60_000
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("l_orderkey"),
        (F.col("id") % 1000).alias("l_partkey"),
        F.col("id").cast("double").alias("l_quantity"),
    )
    orders = spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 97).alias("o_custkey"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = marts.fact_orders(lines, orders, TEST_STAR)
        plan = _final_plan(fact)
        assert "skew=true" in plan, plan
        assert fact.count() == n
        assert fact.filter(F.col("l_orderkey") == 7).count() == n // 3 + (1 if 7 % 3 else 0)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    latest = dedup.latest_per_key(df.repartition(8), ["k"], ["t"])
    assert latest.filter("k = 1").collect()[0]["t"] == 29_997  # ids 0, 3, ... and 1 itself
    assert latest.count() == 20_000
