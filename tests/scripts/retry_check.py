"""Run with task retries on (local[4,3]); one task of the pipeline fails on its
first attempt. The retried result must equal the result of a clean run."""
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from alertflow.operators import ranking as R  # noqa: E402
from alertflow.session import build_session  # noqa: E402

spark = build_session("local[4,3]", 4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="retry-")})
df = spark.range(0, 4000, numPartitions=4).select("id", (F.col("id") % 5).cast("string").alias("c"))


def flaky(batches):
    ctx = TaskContext.get()
    for pdf in batches:
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected executor loss")
        yield pdf


flaky_df = df.mapInPandas(flaky, df.schema)
clean = sorted(R.stratified_split(df, "id", "c").collect())
retried = sorted(R.stratified_split(flaky_df, "id", "c").collect())
assert clean == retried, "retried result differs"
clean_r = sorted(R.exact_rank(df, "id", ["c"]).collect())
retried_r = sorted(R.exact_rank(flaky_df, "id", ["c"]).collect())
assert clean_r == retried_r
from alertflow.operators.dedup import first_per_key  # noqa: E402
obj = lambda d: d.withColumn("obj", F.col("id") % 37)
assert sorted(first_per_key(obj(df), ["obj"], ["c", "id"]).collect()) == \
    sorted(first_per_key(obj(flaky_df), ["obj"], ["c", "id"]).collect())
# a stream: file twin -> (flaky) map -> one row per object and batch -> files
from alertflow.session import scratch_path  # noqa: E402
from alertflow.streaming import sources as SS  # noqa: E402
from alertflow.streaming.classify import first_of_batch  # noqa: E402

events = df.select(F.concat(F.lit("o"), F.col("id") % 37).alias("object_id"), F.col("id").alias("alert_id"),
                   F.timestamp_seconds(F.col("id") * 7).alias("meta_time"))
twin = scratch_path(spark, "retry_twin")
files = SS.write_time_ordered(events, twin, slices=3, order_col="meta_time", rows_per_file=400)


def streamed(mapped):
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(twin)
    rows = rows.mapInPandas(flaky, events.schema) if mapped else rows
    out = scratch_path(spark, "retry_out")
    q = (rows.writeStream.foreachBatch(lambda b, i: first_of_batch(b).write.mode("overwrite").parquet(f"{out}/batch={i}"))
         .option("checkpointLocation", scratch_path(spark, "retry_ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(spark.read.parquet(out).collect())


flaky_once, plain = streamed(True), streamed(False)
assert flaky_once == plain and len(plain) == 3 * 37, (len(flaky_once), len(plain))
print("RETRY-OK", len(clean))
spark.stop()
