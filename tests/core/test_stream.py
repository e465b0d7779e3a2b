from pyspark.sql import functions as F

from millrace.operators import staging
from millrace.plans import catalogue


def test_stream_is_written_and_read_by_many_tasks(spark, tmp_path):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 25).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.lit(6).cast("long").alias("n_chars"))
    docs.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    mark = staging.mark()
    got = catalogue.streaming_dedup(spark, str(tmp_path))
    assert sorted(r._ord for r in got.collect()) == list(range(25))
    paths = staging._written[mark:]
    base = next(p for p in paths if "millrace-stream-" in p)
    assert len(staging.sizes(spark, f"{base}/in", ".parquet")) > 3
    assert sorted(r.batch for r in spark.read.parquet(f"{base}/out/parts").select("batch").distinct().collect()) == [0, 1, 2]
    assert not [p for p in paths if "millrace-batch-" in p]
    staging.release(spark, mark)
