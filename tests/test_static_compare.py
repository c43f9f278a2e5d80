"""A static reference against each arriving batch of a stream."""

from pyspark.sql import functions as F

from shelfwise.streaming import feeds


def test_each_batch_meets_the_reference(spark, tmp_path):
    path = str(tmp_path / "in")
    for low in (0, 10):
        spark.range(low, low + 5).coalesce(1).write.mode("append").parquet(path)
    reference = spark.range(3, 12)
    stream = feeds.read_stream(spark, path, reference.schema, per_trigger=1)

    def shared(static, batch):
        return batch.join(static, "id").agg(F.count("*").alias("n"), F.sum("id").alias("total"))

    schema = shared(reference, reference).schema
    got = feeds.compare_with_reference(stream, reference, shared, "shared", schema).collect()
    assert sorted((r.n, r.total) for r in got) == [(2, 7), (2, 21)] and {r.batch for r in got} == {0, 1}
