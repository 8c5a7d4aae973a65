"""A store of alerts that range filters read only in part.

A batch is a folder, cut into days. Within a day, rows are ordered by the power of two below
the alert's size, then by symbol, then by the size itself. So a range of sizes and a
choice of symbols each leave out row groups and pages by the statistics that Parquet keeps, and a
range of time leaves out folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickguard.session import folder_exists, settle

SIZE, DAY, OCTAVE = "alert_size", "alert_day", "_octave"
ROW_GROUP_BYTES = 32 << 20


def write_batch(alerts: DataFrame, root: str, batch_id: int, time: str, measure: str,
                row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Replace the ``batch_id`` folder of ``root`` by these alerts.

    ``measure`` is the size, an SQL expression. Partitions are ranges of the order, told apart by the
    place in a written copy, so neither a busy symbol nor equal alerts need fit one task.
    Alerts without a time, size or symbol are kept; no range finds them.
    """
    size = F.expr(measure).cast("double")
    placed = settle(alerts.drop("batch_id").withColumns({
        SIZE: size, DAY: F.to_date(time), OCTAVE: F.floor(F.log2(size))}), "alerts")
    order = [DAY, OCTAVE, "symbol", SIZE]
    (placed.withColumn("_turn", F.monotonically_increasing_id())
     .repartitionByRange(*order, "_turn").sortWithinPartitions(*order).drop("_turn", OCTAVE)
     .write.mode("overwrite").option("parquet.block.size", row_group_bytes)
     .partitionBy(DAY).parquet(f"{root}/batch_id={batch_id}"))


def read_store(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All alerts with their size, batch and day; none before the first batch."""
    layout = T.StructType([*schema.fields, T.StructField(SIZE, T.DoubleType()),
                           T.StructField("batch_id", T.LongType()), T.StructField(DAY, T.DateType())])
    if not folder_exists(spark, root):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(root)


def read_range(spark: SparkSession, root: str, schema: T.StructType, time: str, chosen: list[str] | None = None,
               low: float | None = None, high: float | None = None,
               since: str | None = None, until: str | None = None) -> DataFrame:
    """Alerts of the ``chosen`` symbols, with sizes and times in inclusive ranges; null leaves a side open.

    Every condition is a plain comparison of a stored column, so it reaches the scan.
    """
    found = read_store(spark, root, schema)
    if chosen is not None:
        found = found.filter(F.col("symbol").isin(list(chosen)))
    if low is not None:
        found = found.filter(F.col(SIZE) >= F.lit(float(low)))
    if high is not None:
        found = found.filter(F.col(SIZE) <= F.lit(float(high)))
    for edge, keeps in ((since, lambda c, e: c >= e), (until, lambda c, e: c <= e)):
        if edge is not None:
            at = F.lit(edge).cast("timestamp")
            found = found.filter(keeps(F.col(time), at) & keeps(F.col(DAY), F.to_date(at)))
    return found.drop(SIZE, DAY)
