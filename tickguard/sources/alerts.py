"""Alert files, in the partitioned layout of our sinks or as a flat folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickguard.schema import VOLATILITY_ALERT, ZSCORE_ALERT
from tickguard.session import folder_exists

# File name patterns of the flat layout, one family each.
FAMILIES = {
    "volatility": ("alerts_batch_*.csv", VOLATILITY_ALERT),
    "zscore": ("zscore_alerts_batch_*.csv", ZSCORE_ALERT),
}
#: What a row was, beside the values that its file's header names.
ODD, FILE = "_odd", "_file"


def _listed(spark: SparkSession, folder: str, family: str) -> DataFrame:
    """Lines of the family's files, each file's lines numbered upwards; none for a folder not there yet."""
    pattern, _ = FAMILIES[family]
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], f"value string, {FILE} string, at long")
    return (spark.read.option("pathGlobFilter", pattern).text(folder)
            .select("value", F.col("_metadata.file_path").alias(FILE),
                    (F.col("_metadata.file_block_start") * (1 << 20) + F.pmod(
                        F.monotonically_increasing_id(), F.lit(1 << 33))).alias("at")))


def header_catalogue(spark: SparkSession, folder: str, family: str) -> DataFrame:
    """(header, files): the distinct first lines, as names, and the files that have them.

    A header is null where the first line is none: names are plain words, no two alike, and
    the family knows one of them at least.
    """
    names = F.array(*[F.lit(name) for name in FAMILIES[family][1].names])
    first = (_listed(spark, folder, family).filter("trim(value) <> ''").groupBy(FILE)
             .agg(F.min_by("value", "at").alias("line")))
    told = F.transform(F.split("line", ","), lambda f: F.trim(F.regexp_replace(f, '"', "")))
    fits = (F.arrays_overlap(told, names) & F.forall(told, lambda f: f.rlike("^[A-Za-z_][A-Za-z0-9_ ]*$"))
            & (F.size(told) == F.size(F.array_distinct(F.transform(told, F.lower)))))
    return first.groupBy(F.when(fits, told).alias("header")).agg(F.collect_list(FILE).alias("files"))


def _scan(spark: SparkSession, header: list[str], files: list[str]) -> DataFrame:
    """One CSV scan of the files that share a header: its columns as text, the file, and whether the row is odd.

    Quotes keep commas and line ends together. A row of fewer or more values than the
    header has is odd; so is a repeated header.
    """
    layout = T.StructType([*[T.StructField(name, T.StringType()) for name in header], T.StructField(ODD, T.StringType())])
    rows = (spark.read.schema(layout).option("header", "true").option("enforceSchema", "true").option("multiLine", "true")
            .option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", ODD).csv(files))
    again = reduce(lambda a, b: a & b, (F.col(f"`{name}`") == F.lit(name) for name in header))
    odd = F.col(ODD).isNotNull() | F.coalesce(again, F.lit(False))
    return rows.select(*[F.col(f"`{name}`") for name in header], F.col("_metadata.file_path").alias(FILE), odd.alias(ODD))


def _scans(spark: SparkSession, folder: str, family: str) -> tuple[list[DataFrame], list[str]]:
    """A scan of each header's files, and the files without a header.

    The driver learns the headers, which are few, and the names of the files, as for any scan.
    """
    listed = header_catalogue(spark, folder, family).collect()
    return ([_scan(spark, row.header, sorted(row.files)) for row in listed if row.header],
            [file for row in listed if not row.header for file in row.files])


def read_flat_alerts(spark: SparkSession, folder: str, family: str, extras: bool = False) -> DataFrame:
    """All files of one family, by column name; the batch id comes from the file name.

    Files are grouped by their header and each group is read by one typed scan, so values may
    hold quoted commas and line ends. Columns may stand in any order, and those that a file
    lacks are null; columns that the family does not know come back as text with ``extras``. Rows that do not fit their header, and files without one, are not among
    the alerts but in ``unreadable_flat_alerts``. A folder that is not there yet has no alerts.
    """
    _, schema = FAMILIES[family]
    known = {*schema.names, FILE, ODD, "batch_id"}
    batch = F.regexp_extract(FILE, r"batch_(\d+)[^/]*$", 1).cast("long").alias("batch_id")

    def typed(rows: DataFrame) -> DataFrame:
        return rows.filter(~F.col(ODD)).select(
            *[F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name)
              for f in schema.fields if f.name in rows.columns],
            *[F.col(f"`{name}`") for name in rows.columns if extras and name not in known], batch)

    none = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    scans, _ = _scans(spark, folder, family)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(typed, scans), none)


def unreadable_flat_alerts(spark: SparkSession, folder: str, family: str) -> DataFrame:
    """(file, lines) that ``read_flat_alerts`` leaves out: odd rows by file, and all lines of files without a header."""
    scans, headless = _scans(spark, folder, family)
    odd = [rows.filter(ODD).select(F.col(FILE).alias("file")) for rows in scans]
    lines = _listed(spark, folder, family).filter(F.col(FILE).isin(headless) & (F.trim("value") != ""))
    rows = reduce(DataFrame.unionByName, odd, lines.select(F.col(FILE).alias("file")))
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("lines"))


def read_alerts(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Alerts below ``batch_id=N`` folders; a batch filter prunes the folders read.

    Our own sink wrote them, so a file that does not fit the schema is an error.
    Before the first alert there is no folder, and no row.
    """
    layout = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not folder_exists(spark, root):
        return spark.createDataFrame([], layout)
    return (spark.read.schema(layout).option("header", "true").option("enforceSchema", "false")
            .csv(root))


def union_alerts(families: dict[str, DataFrame]) -> DataFrame:
    """Bag union by column name; columns a family lacks are null."""
    tagged = [df.withColumn("family", F.lit(name)) for name, df in families.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
