"""Late trades as a relation: a stream routed against its own watermark.

Spark only counts what comes too late. Here every batch is split by the watermark that
the batches before it have set, the greatest event time so far less the allowed lateness:
trades from the mark on go to ``kept``, older ones to ``late``, each batch into its own
folder. The mark is written per batch too, so a replayed batch is routed as it was first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickguard.session import folder_exists

MARK = "batch_id long, latest timestamp"


def _mark(spark: SparkSession, marks: str, batch_id: int, lateness: str):
    """The watermark that the batches before ``batch_id`` have set, or None at first."""
    if not folder_exists(spark, marks):
        return None
    seen = spark.read.schema(MARK).parquet(f"{marks}/*").filter(F.col("batch_id") < batch_id)
    return seen.agg((F.max("latest") - F.expr(f"INTERVAL {lateness}")).alias("mark")).first()[0]


def route(batch: DataFrame, mark) -> DataFrame:
    """``batch`` with ``late``: a trade is late if its time lies before ``mark``; one without a time never is."""
    if mark is None:
        return batch.withColumn("late", F.lit(False))
    return batch.withColumn("late", F.coalesce(F.col("event_time") < F.lit(mark), F.lit(False)))


def routing_job(trades: DataFrame, root: str, checkpoint: str, lateness: str) -> DataStreamWriter:
    """Trades to ``root``/kept and ``root``/late, by batch; kept plus late are all trades."""
    marks = f"{root}/marks"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation("times")
        mark = _mark(spark, marks, batch_id, lateness)
        (route(batch, mark).observe(seen, F.max("event_time").alias("latest"))
         .withColumn("side", F.when(F.col("late"), "late").otherwise("kept")).drop("late")
         .write.mode("overwrite").partitionBy("side").parquet(f"{root}/routed/batch_id={batch_id}"))
        (spark.createDataFrame([(batch_id, seen.get.get("latest"))], MARK).coalesce(1)
         .write.mode("overwrite").parquet(f"{marks}/batch_{batch_id}"))

    return (trades.writeStream.outputMode("append").foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint))


def read_routed(spark: SparkSession, root: str, layout: DataFrame, side: str | None = None) -> DataFrame:
    """What has been routed, with batch_id and side; a side's filter prunes the folders read."""
    schema = f"{', '.join(f'`{n}` {k}' for n, k in layout.dtypes)}, batch_id long, side string"
    if not folder_exists(spark, f"{root}/routed"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{root}/routed")
    return rows if side is None else rows.filter(F.col("side") == side)
