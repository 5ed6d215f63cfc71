import datetime

from pyspark.sql import functions as F

from tidemark.catalog.stream_queries import write_slices
from tidemark.session import shuffle_width


def test_slices_are_spread_and_whole(spark, tmp_path):
    """Every slice is as many files as the session has shuffle partitions; a row without a time is not lost."""
    start = datetime.datetime(2024, 1, 1)
    rows = [(k, start + datetime.timedelta(minutes=k)) for k in range(4001)] + [(9999, None)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz")
    n = write_slices(events, f"{tmp_path}/many", late=True)
    assert n == shuffle_width(spark) > 1
    back = spark.read.parquet(f"{tmp_path}/many")
    files = back.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
    assert len(files) == 5 * n and max(r["n"] for r in files) <= 1002 // n + 20
    assert back.filter("ts is null").count() == 1 and back.count() == 4002 + 180


def test_small_slices_are_filled_up(spark, tmp_path):
    events = spark.createDataFrame([(1, datetime.datetime(2024, 1, 1)), (2, datetime.datetime(2024, 1, 2))], "event_id bigint, ts timestamp_ntz")
    for k, some in enumerate((events, events.limit(0))):
        n = write_slices(some, f"{tmp_path}/{k}")
        assert len(spark.read.parquet(f"{tmp_path}/{k}").inputFiles()) == (4 * n if k == 0 else n)
