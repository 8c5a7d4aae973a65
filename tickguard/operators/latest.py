"""The latest revision of every window as a maintained table.

The table is partitioned by the day of the window's start. A batch of new alerts is merged
with the days that it touches and only those days are rewritten; files of other days stay as
they are. Merging keeps the greatest revision, so a batch may come again, or in another order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickguard.operators.dedup import latest_revision
from tickguard.session import folder_exists, settle


def _day():
    return F.coalesce(F.date_format("window_start", "yyyy-MM-dd"), F.lit("none")).alias("day")


def read_latest(spark: SparkSession, root: str, layout: str) -> DataFrame:
    """The maintained table with its ``day``; empty before the first batch."""
    schema = f"{layout}, day string"
    if not folder_exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def merge_batch(alerts: DataFrame, root: str) -> None:
    """Bring the ``alerts`` of a batch, with their batch_id, into the table at ``root``.

    The days that change are known from the batch alone and are joined as a filter that
    prunes the folders read. The merged rows are written to the shared folder first: the
    days are replaced only when all of them are ready, and a replay after a crash repairs
    the ones that were not.
    """
    spark = alerts.sparkSession
    layout = ", ".join(f"`{n}` {k}" for n, k in alerts.dtypes)
    new = settle(latest_revision(alerts).select("*", _day()), "batch")
    days = new.select("day").distinct()
    old = read_latest(spark, root, layout).join(F.broadcast(days), "day", "left_semi") if folder_exists(
        spark, root) else new.limit(0)
    merged = settle(latest_revision(new.drop("day").unionByName(old.drop("day"))).select("*", _day()), "days")
    (merged.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(root))
