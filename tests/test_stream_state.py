from tidemark.session import scratch_path
from tidemark.streaming import streams as sm

VERSIONS = "spark.sql.streaming.maxBatchesToRetainInMemory"


def test_streams_keep_one_version_of_their_state_in_memory(spark):
    source, seen = scratch_path(spark, "versions-in"), []
    for k in range(3):
        spark.range(k, k + 5).coalesce(1).write.mode("append").parquet(source)
    before = spark.conf.get(VERSIONS)
    stream = sm.file_stream(spark, source, spark.range(1).schema, files_per_batch=1).dropDuplicates(["id"])

    def each(rows, batch):
        seen.append((rows.sparkSession.conf.get(VERSIONS), sorted(r["id"] for r in rows.collect())))

    sm.run_batches(stream, each, scratch_path(spark, "versions-state"))
    assert {v for v, _ in seen} == {"1"} and sorted(i for _, ids in seen for i in ids) == list(range(7))
    assert spark.conf.get(VERSIONS) == before
