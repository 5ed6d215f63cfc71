"""Rows out of reach of every as-of leave at the scan, not after a grouping or a join."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators.spine import active_rows, attach_as_of

AS_OFS = ["2024-01-10 00:00:00", "2024-03-10 00:00:00"]


def test_reach_is_a_filter_of_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.sql("SELECT id, TIMESTAMP_NTZ'2023-12-01' + id * INTERVAL '1' DAY AS t, CAST(NULL AS timestamp_ntz) AS until FROM range(200)").write.parquet(path)
    spark.range(200).select("id").write.parquet(path + "2")
    rows = spark.read.parquet(path).join(spark.read.parquet(path + "2"), "id")
    near = attach_as_of(rows, "t", AS_OFS, timedelta(days=2), "both")
    assert "GreaterThanOrEqual(t," in near._jdf.queryExecution().executedPlan().toString()
    found = sorted((r["t"], r["as_of_time"]) for r in near.collect())
    moments = [datetime.fromisoformat(a) for a in AS_OFS]
    assert found == [(a - timedelta(days=k), a) for a in moments for k in (2, 1, 0)]
    started = active_rows(rows, "t", "until", AS_OFS)
    assert started.groupBy("as_of_time").agg(F.count("*").alias("n")).orderBy("as_of_time").collect() == [(moments[0], 41), (moments[1], 101)]
