"""A keyed message log in files, that streams can replay from any position.

A shard is a folder of segments, each a file of JSON lines named by the sequence
numbers it holds: ``shard=3/00000000000000000100-00000000000000000250.jsonl`` has the
messages 100 to 249. Offsets therefore come from the listing alone; no message passes
the driver, and executors open only the segments of their own ranges.

``LATEST`` starts behind the last message that is there when the query starts first,
``TRIM_HORIZON`` at the oldest one kept. A poll takes at most ``limit`` messages of each
shard. A batch is one poll; while messages are left behind, each batch takes twice the polls
of the one before, ``polls`` at most, so that a long backlog is not a batch a poll.
Spark logs the ranges, so a restarted query goes on where it stopped; the end of
the last batch is also kept in the folder ``positions``, since Spark does not tell a Python
source where the last run ended. After a crash between the two, the next batch also takes
the range of the lost one, and no message is lost or doubled.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tickguard.params import FeedRate
from tickguard.session import fresh_dir, remove_folder, settle

FORMAT = "message_log"
MESSAGE = "shard int, sequence long, value string"
_ARROW = pa.schema([("shard", pa.int32()), ("sequence", pa.int64()), ("value", pa.string())])
SEGMENT = re.compile(r"shard=(\d+)/(\d{20})-(\d{20})\.jsonl$")


def _files(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    if urlparse(path).scheme:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _segments(root: str) -> dict[int, list[tuple[int, int, str]]]:
    """(first, next, path) of the segments of every shard, in order."""
    from pyarrow import fs

    system, where = _files(root)
    found: dict[int, list[tuple[int, int, str]]] = {}
    for info in system.get_file_info(fs.FileSelector(where, recursive=True, allow_not_found=True)):
        if name := SEGMENT.search(info.path):
            shard, first, after = map(int, name.groups())
            found.setdefault(shard, []).append((first, after, info.path))
    return {shard: sorted(parts) for shard, parts in found.items()}


class Range(InputPartition):
    """Messages [first, after) of one segment."""

    def __init__(self, shard: int, path: str, base: int, first: int, after: int):
        super().__init__(path)
        self.shard, self.path, self.base, self.first, self.after = shard, path, base, first, after


def _ranges(root: str, start: dict[str, int], end: dict[str, int]) -> list[Range]:
    made = []
    for shard, parts in _segments(root).items():
        low, high = start.get(str(shard), 0), end.get(str(shard), 0)
        made += [Range(shard, path, first, max(first, low), min(after, high))
                 for first, after, path in parts if first < high and after > low]
    return made


def _messages(root: str, part: Range) -> Iterator[pa.RecordBatch]:
    system, _ = _files(root)
    with system.open_input_stream(part.path) as raw:
        rest, at = b"", part.base
        while at < part.after and (block := raw.read(1 << 20)):
            if at + (ends := block.count(b"\n")) <= part.first:     # all before the range
                rest, at = block[block.rfind(b"\n") + 1:] if ends else rest + block, at + ends
                continue
            *lines, rest = (rest + block).split(b"\n")
            low, high = max(part.first - at, 0), min(part.after - at, len(lines))
            if low < high:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.shard] * (high - low), pa.int32()),
                     pa.array(range(at + low, at + high), pa.int64()),
                     pa.array([line.decode("utf-8", "replace") for line in lines[low:high]], pa.string())],
                    schema=_ARROW)
            at += len(lines)


class LogTable(DataSourceReader):
    """The whole log as a table."""

    def __init__(self, options: dict):
        self.root = options["path"]

    def partitions(self) -> list[Range]:
        ends = {str(shard): parts[-1][1] for shard, parts in _segments(self.root).items()}
        return _ranges(self.root, {}, ends) or [Range(0, "", 0, 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        return _messages(self.root, part) if part.path else iter(())


class LogStream(DataSourceStreamReader):
    """The log as a stream; offsets are the next sequence number of each shard."""

    def __init__(self, options: dict):
        self.root, self.start = options["path"], options.get("startingposition", "LATEST")
        self.limit = int(options.get("limit", 100))
        self.polls, self.most_polls = 1, int(options.get("polls", 1))
        self.kept = f"{options['positions'].rstrip('/')}/position.json" if "positions" in options else None
        if self.start not in ("LATEST", "TRIM_HORIZON"):
            raise ValueError(f"startingPosition is LATEST or TRIM_HORIZON, not {self.start}")
        self.first, self.position = self._recalled()

    def _recalled(self) -> tuple[dict[str, int] | None, dict[str, int] | None]:
        """Where the query began, and where its last poll ended."""
        from pyarrow import fs

        if self.kept is None:
            return None, None
        system, where = _files(self.kept)
        if system.get_file_info(where).type == fs.FileType.NotFound:
            return None, None
        with system.open_input_stream(where) as raw:
            return tuple(json.loads(raw.read()))

    def _keep(self) -> None:
        if self.kept is not None:
            system, where = _files(self.kept)
            system.create_dir(where.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(f"{where}.new") as out:
                out.write(json.dumps([self.first, self.position]).encode())
            system.move(f"{where}.new", where)

    def initialOffset(self) -> dict[str, int]:
        if self.first is None:
            at = 0 if self.start == "TRIM_HORIZON" else -1
            self.first = {str(s): parts[at][0 if at == 0 else 1] for s, parts in _segments(self.root).items()}
            self.position = self.first
            self._keep()
        return self.first

    def latestOffset(self) -> dict[str, int]:
        """The end of the next batch. Spark asks for it before it asks where to begin."""
        self.initialOffset()
        before = self.position
        after, behind = {}, False
        for shard, parts in _segments(self.root).items():
            at = max(before.get(str(shard), 0), parts[0][0])
            after[str(shard)] = max(at, min(at + self.polls * self.limit, parts[-1][1]))
            behind = behind or after[str(shard)] < parts[-1][1]
        self.polls = min(2 * self.polls, self.most_polls) if behind else 1
        self.position = {**before, **after}
        if self.position != before:
            self._keep()
        return self.position

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Range]:
        return _ranges(self.root, start, end)

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        return _messages(self.root, part)

    def commit(self, end: dict[str, int]) -> None:
        pass


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> LogTable:
        return LogTable(self.options)

    def streamReader(self, schema) -> LogStream:
        return LogStream(self.options)


def _register(spark: SparkSession) -> None:
    """Make the format known to this session, once; Spark registers with the thread's active one."""
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)
    try:
        spark.dataSource.register(MessageLog)
    except AnalysisException as e:
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise


def read_log(spark: SparkSession, root: str) -> DataFrame:
    _register(spark)
    return spark.read.format(FORMAT).load(root)


def stream_log(
    spark: SparkSession, root: str, positions: str, start: str = "LATEST", rate: FeedRate = FeedRate(),
) -> DataFrame:
    """Messages as (shard, sequence, value); ``positions`` is a folder of the query's own."""
    _register(spark)
    return (spark.readStream.format(FORMAT).option("startingPosition", start).option("positions", positions)
            .option("limit", rate.messages_per_shard).option("polls", rate.polls_per_trigger).load(root))


def append_messages(messages: DataFrame, root: str, shards: int, *order: str, per_segment: int = 1_000_000) -> None:
    """Append ``messages`` (key, value) to the log; a key's messages are in one shard, in the given order.

    A shard's messages are laid out in ranges of the order, so a busy shard is written by
    several tasks, and its segments get their sequence numbers from the counts of their
    files. Line ends inside a value must be escaped, as JSON does. One writer at a time.
    """
    spark = messages.sparkSession
    made = fresh_dir(spark, "segments")
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
    rows = settle(messages.withColumn("shard", shard), "messages").withColumn(
        "_turn", F.monotonically_increasing_id())
    (rows.repartitionByRange("shard", *order, "_turn").sortWithinPartitions("shard", *order, "_turn")
     .select("shard", "value").write.option("maxRecordsPerFile", per_segment).partitionBy("shard").text(made))
    sizes = (spark.read.text(made).groupBy(F.col("_metadata.file_path").alias("path"))
             .agg(F.count(F.lit(1)).alias("lines")).collect())
    ends = {s: parts[-1][1] for s, parts in _segments(root).items()}
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in sorted(sizes, key=lambda r: r.path):          # part numbers follow the ranges
        number = int(re.search(r"shard=(\d+)/", row.path).group(1))
        first = ends.get(number, 0)
        ends[number] = first + row.lines
        target = hadoop.Path(f"{root}/shard={number}/{first:020d}-{ends[number]:020d}.jsonl")
        files.mkdirs(target.getParent())
        files.rename(hadoop.Path(row.path), target)
    remove_folder(spark, made)
