"""Helpers that several operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of texts that a Python worker gets at once: bounds its memory, whatever the texts' lengths.
BATCH_BYTES = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but the six white-space characters of ASCII, which is
#: what ``bytes.split()`` cuts at.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def lower_ascii(col: str | Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def fold(doc_id: str | Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id is in the fold of an empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit(""))), F.lit(of))


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts of a batch as UTF-8; null is empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as Spark sends any Python files."""
    import os
    import tempfile
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "tickguard.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
