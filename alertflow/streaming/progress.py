"""Totals over the whole life of a streaming query.

``recentProgress`` keeps the last hundred reports of one run. :class:`ProgressLog`
is a listener that writes every finished batch's report as a small file, so totals
cover all batches of all runs; a batch reported twice counts once, by its last
report. The distinct ids a stateful query has processed are read from its state
store as a table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from alertflow.sinks.committed import exists, put_text

REPORT = ("id string, runId string, batchId long, timestamp string, numInputRows long, durationMs map<string, long>, "
          "sink struct<description: string, numOutputRows: long>")


class ProgressLog(StreamingQueryListener):
    """Writes the report of every batch to ``root/<query id>/<batch>-<run>.json``; ``spark.streams.addListener`` it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        if "addBatch" not in p.get("durationMs", {}):
            return  # an idle trigger
        path = f"{self.root}/{p['id']}/{p['batchId']}-{p['runId']}.json"
        if not exists(self.spark, path):
            put_text(self.spark, path, json.dumps(p))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, root: str, query_id: str | None = None) -> DataFrame:
    """One row per batch: ``query_id, batch_id, run_id, at, input_rows, ms``."""
    root = root.rstrip("/")
    path = f"{root}/{query_id}" if query_id else root
    if not exists(spark, path):
        return spark.createDataFrame([], "query_id string, batch_id long, run_id string, at timestamp, input_rows long, ms long")
    rows = spark.read.option("recursiveFileLookup", "true").schema(REPORT).json(path).select(
        F.col("id").alias("query_id"), F.col("batchId").alias("batch_id"), F.col("runId").alias("run_id"),
        F.to_timestamp("timestamp").alias("at"), F.col("numInputRows").alias("input_rows"),
        F.col("durationMs")["triggerExecution"].alias("ms"))
    last = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("at"), "run_id")
    return rows.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def lifetime_totals(spark: SparkSession, root: str) -> DataFrame:
    """Per query: batches, runs, input rows, seconds of processing and rows per second, over its whole life."""
    g = read_progress(spark, root).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("batches"), F.count_distinct("run_id").alias("runs"), F.sum("input_rows").alias("input_rows"),
        (F.sum("ms") / 1000).alias("seconds"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    return g.withColumn("rows_per_sec", F.try_divide("input_rows", "seconds"))


def state_keys(spark: SparkSession, checkpoint: str, operator_id: int = 0, store: str = "default") -> DataFrame:
    """The keys a stateful operator holds, as columns: for a deduplicated stream the ids processed so far."""
    reader = spark.read.format("statestore").option("operatorId", str(operator_id)).option("storeName", store)
    return reader.load(checkpoint).select("key.*")
