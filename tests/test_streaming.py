from pyspark.sql import functions as F

from arpent.fixtures import table
from arpent.streaming.zonal import windowed_zonal_stats


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(((F.col("event_id") * 53) % 1250 / 10).alias("x"), ((F.col("event_id") * 29) % 120 / 10).alias("y"), "value", F.col("ts").cast("timestamp").alias("ts"))
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    zones = table(spark, sf_dir, "zone")
    batch = windowed_zonal_stats(spark.read.parquet(f"{tmp_path}/in"), zones, "value", "ts", "1 hour", "10 days", 25.0)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = windowed_zonal_stats(stream, zones, "value", "ts", "1 hour", "10 days", 25.0).writeStream.outputMode("complete").format("memory").queryName("zonal_stream").option("checkpointLocation", f"{tmp_path}/cp").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = lambda df: sorted((str(r["window"]["start"]), r["fid"], r["n"], round(r["mean"], 6)) for r in df.collect())
    assert rows(spark.table("zonal_stream")) == rows(batch) and batch.count() > 0
