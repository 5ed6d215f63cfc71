"""The tasks of the per-event velocity grow in number with the events, not in size."""

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import fraud

ARGS = ("u", "t", "v", "id", {"1h": timedelta(hours=1), "24h": timedelta(hours=24)})


def test_partitions_follow_the_events(spark):
    rows = spark.range(300).select("id", (F.col("id") % 7).alias("u"), F.expr("TIMESTAMP_NTZ'2024-01-01' + id * INTERVAL '11' MINUTE").alias("t"), F.col("id").cast("double").alias("v"))
    many, few = fraud.velocity_per_event(rows, *ARGS, task_rows=30), fraud.velocity_per_event(rows, *ARGS)
    assert "hashpartitioning(e#" in many._jdf.queryExecution().executedPlan().toString()
    assert ", 40), REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
