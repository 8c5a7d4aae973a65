"""Compaction of the relay's lots: many small files become few large ones, under a manifest.

The lots stay where they are. A round writes the lines of all small files into files of about a
given size in a folder of its own, and only then a manifest, which names the files that the
new ones replace. Readers follow the last complete manifest: lots that it does not
retire, and the merged files that it names. A round that dies before its manifest is complete changes
nothing that a reader sees, and the next one starts anew. One round may run at a time.

Retired lots are never deleted here, since streams may still have to read them:
``retired_files`` lists them for whoever keeps the folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickguard.schema import RAW_TRADE_LINE
from tickguard.session import complete_folders, folder_exists, settle
from tickguard.sources.trades import read_lines

MANIFEST = "file string, bytes long, merged boolean"
TARGET_BYTES = 128 << 20
LOTS = "*.json"


def _listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(file, bytes) of a folder's files; only the listing is read. Empty files have no lines and are left out."""
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], "file string, bytes long")
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
            .select(F.col("path").alias("file"), F.col("length").alias("bytes")))


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """The last complete manifest: merged files that live, and lots that they replace."""
    done = complete_folders(spark, f"{store}/manifest")
    return spark.read.schema(MANIFEST).parquet(done[-1]) if done else spark.createDataFrame([], MANIFEST)


def retired_files(spark: SparkSession, store: str) -> DataFrame:
    return manifest(spark, store).filter("not merged").select("file", "bytes")


def live_files(spark: SparkSession, root: str, store: str, pattern: str = LOTS) -> DataFrame:
    """(file, bytes, merged): what a reader has to read now."""
    known = manifest(spark, store)
    lots = _listed(spark, root, pattern).join(known.filter("not merged"), "file", "left_anti")
    return lots.withColumn("merged", F.lit(False)).unionByName(known.filter("merged"))


def read_lots(spark: SparkSession, root: str, store: str, pattern: str = LOTS) -> DataFrame:
    """Raw lines of all lots, each once, from merged files where there are some.

    The driver names the files, as it does in any scan of a folder.
    """
    files = [row.file for row in live_files(spark, root, store, pattern).select("file").collect()]
    return read_lines(spark, files) if files else spark.createDataFrame([], RAW_TRADE_LINE)


def _packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A sibling session whose scans put whole small files together up to a size, and no further."""
    sibling = spark.newSession()
    for key, value in {"maxPartitionBytes": target_bytes, "openCostInBytes": 0, "minPartitionNum": 1}.items():
        sibling.conf.set(f"spark.sql.files.{key}", str(value))
    return sibling


def write_merged(spark: SparkSession, files: list[str], folder: str, target_bytes: int = TARGET_BYTES) -> None:
    """The lines of ``files``, as they are, in files of at most about ``target_bytes``.

    Spark's scan packs the files into its partitions by size, so nothing is shuffled.
    """
    _packing_session(spark, target_bytes).read.text(files).write.text(folder)


def compact(spark: SparkSession, root: str, store: str, target_bytes: int = TARGET_BYTES, pattern: str = LOTS) -> int:
    """Merge the live files below half of ``target_bytes``; returns how many there were.

    Merged files that are still small are merged again with the lots that came since. Fewer
    than two small files are left as they are. Blank lines stay; line ends become plain ones.
    """
    live = settle(live_files(spark, root, store, pattern), "live")
    small = live.filter(F.col("bytes") < target_bytes // 2)
    files = [row.file for row in small.select("file").collect()]
    if len(files) < 2:
        return 0
    folder = f"{store}/runs/{uuid.uuid4().hex}"
    write_merged(spark, files, folder, target_bytes)
    commit(spark, store, small, folder)
    return len(files)


def commit(spark: SparkSession, store: str, replaced: DataFrame, folder: str) -> None:
    """Write the next manifest: the files of ``folder`` live, the ``replaced`` ones do not."""
    known = manifest(spark, store)
    new = (_listed(spark, folder).withColumn("merged", F.lit(True))
           .unionByName(replaced.filter("not merged"))
           .unionByName(known.join(replaced.filter("merged"), "file", "left_anti")))
    number = len(complete_folders(spark, f"{store}/manifest"))
    new.write.mode("overwrite").parquet(f"{store}/manifest/{number:010d}")
