"""Repeated byte strings, found with a logarithmic family of sparse suffix arrays.

Every window of 400 bytes names one suffix in it, the one whose first eight bytes
hash lowest among the starts that leave 64 bytes on either side. Equal windows name
the same suffix, so windows can only be equal where named suffixes, and the 64
bytes around them, are. A suffix array of the index therefore holds the named
suffixes only, about one in 130 of all: in the order of their first eight bytes,
and of a hash of their surroundings below that.

New batches get an array of their own, which is scanned against the arrays there
are; suffixes that meet are suspects. Arrays of equal size then merge, so there are
never more than a logarithm of them.

Suspects are settled exactly. A run, the string of all windows that name one
suffix, that occurs twice is repeated as a whole. Where different runs share a
suffix, their windows are compared cell by cell, a cell being the windows that
begin a few bytes apart: cells whose bytes are the same, by 128-bit hashes, are
repeated as a whole, and only where cells agree in the bytes that all their
windows share, but not in the others, are windows compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickguard.llm.common import utf8
from tickguard.session import fresh_dir, settle, settled_for_now

LENGTH, MARGIN, HEAD = 400, 64, 8
CHUNK = 1 << 20           # bytes looked at together
BATCHES = 2
CELL = 16                 # windows of a run that are compared together at first

NAMED = "k binary, start bigint, windows bigint, head bigint, around bigint, run binary, at bigint"
CELLS = "core bigint, h1 bigint, h2 bigint, id bigint, lo bigint, hi bigint"


def _heads(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as big-endian numbers."""
    n = len(data) - HEAD + 1
    heads = np.zeros(n, np.uint64)
    for i in range(HEAD):
        heads |= data[i:i + n].astype(np.uint64) << np.uint64(8 * (HEAD - 1 - i))
    return heads


def _named(heads: np.ndarray, length: int, margin: int) -> np.ndarray:
    """For each window, the place of the suffix that it names."""
    mixed = heads * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    # The place in the low bits: of equal hashes the first counts.
    mixed &= np.uint64(0xFFFFFFFFFF000000)
    mixed |= np.arange(len(mixed), dtype=np.uint64)
    wide = length - 2 * margin - HEAD + 1
    least = mixed[margin:len(mixed) - margin]
    blocks = -(-len(least) // wide)
    padded = np.full(blocks * wide, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(least)] = least
    table = padded.reshape(blocks, wide)
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(table, axis=1).ravel()
    n = len(least) - wide + 1
    return (np.minimum(after[:n], before[wide - 1:wide - 1 + n]) & np.uint64(0xFFFFFF)).astype(np.int64)


def named_suffixes(texts: list[bytes], length: int, margin: int) -> Iterator[tuple]:
    """(text, first window, windows, head, hash around, hash of the run, place in it of the suffix) of every run.

    Texts are looked at in chunks that overlap by a window less one byte. A run
    that a chunk cuts gives two runs, which loses nothing.
    """
    pieces: list[tuple[int, int, int]] = []          # text, from, to
    held = 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), CHUNK):
            pieces.append((i, at, min(at + CHUNK + length - 1, len(text))))
            held += pieces[-1][2] - at
            if held >= CHUNK:
                yield from _runs(texts, pieces, length, margin)
                pieces, held = [], 0
    if pieces:
        yield from _runs(texts, pieces, length, margin)


def _runs(texts: list[bytes], pieces: list[tuple[int, int, int]], length: int, margin: int):
    joined = b"".join([texts[i][a:b] for i, a, b in pieces])
    heads = _heads(np.frombuffer(joined, np.uint8))
    names = _named(heads, length, margin)
    sizes = np.array([b - a for _, a, b in pieces])
    first = np.cumsum(sizes) - sizes
    # Windows over two pieces are none.
    inside = np.zeros(len(names) + 1, np.int32)
    inside[first] += 1
    np.add.at(inside, first + sizes - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    change = np.empty(len(names), bool)
    change[0] = True
    change[1:] = (names[1:] != names[:-1]) | (inside[1:] != inside[:-1])
    change[first] = True
    begins = np.flatnonzero(change)
    ends = np.append(begins[1:], len(names))
    keep = inside[begins]
    begins, ends = begins[keep], ends[keep]
    piece = np.searchsorted(first, begins, "right") - 1
    at = names[begins]
    head = heads[at].astype(np.int64).tolist()
    around, whole = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest
    for j, (p, a, b, s) in enumerate(zip(piece.tolist(), begins.tolist(), ends.tolist(), at.tolist(),
                                         strict=True)):
        i, begin, _ = pieces[p]
        near = around(joined[s - margin:s + HEAD + margin])
        yield (i, a - int(first[p]) + begin, b - a, head[j], near - (1 << 64) if near >> 63 else near,
               whole(joined[a:b - 1 + length]), s - a)


def _name_rows(length: int, margin: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        names = ["k", "start", "windows", "head", "around", "run", "at"]
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            out: list[tuple] = []
            for i, *rest in named_suffixes(texts, length, margin):
                out.append((keys[i], *rest))
                if len(out) >= 1 << 16:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows


class SuffixIndex:
    """Sparse suffix arrays of geometrically growing sizes: (head, around, n), sorted."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, DataFrame]] = []       # (batches in it, array), largest first

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Take in a batch with head and around; the suffixes seen twice by now, as far as it has them.

        Arrays of equal size merge before the next batch comes, smallest first.
        """
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (a, one), (b, two) = self.levels.pop(), self.levels.pop()
            self.levels.append((a + b, self._array(one.union(two))))
        new = self._array(suffixes.select("head", "around", F.lit(1).cast("long").alias("n")))
        met = new.filter("n > 1").select("head", "around")
        for _, level in self.levels:
            met = met.union(new.select("head", "around").join(
                level.select("head", "around"), ["head", "around"], "left_semi"))
        self.levels.append((1, new))
        return settle(met.distinct(), "met")

    def _array(self, rows: DataFrame) -> DataFrame:
        merged = rows.groupBy("head", "around").agg(F.sum("n").alias("n"))
        return settle(merged.sortWithinPartitions("head", "around"), "suffixes")


def _cell_rows(length: int, width: int):
    """The cells of ``width`` windows in parts of runs, by how far before the suffix the windows begin.

    A part has the windows that begin ``lo`` to ``hi`` bytes before the suffix at ``s``.
    Equal windows begin equally far before their suffix, so they are in like cells,
    which agree in the bytes that all windows of a full cell share, hashed as ``core``.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, wide = xxhash.xxh3_64_digest, xxhash.xxh3_128_digest
        for batch in batches:
            cores: list[bytes] = []
            hashes: list[bytes] = []
            told: list[tuple[int, int, int]] = []
            for text, parts in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                for part in parts:
                    s, lo, hi, run = part["s"], part["lo"], part["hi"], part["id"]
                    for first in range(lo - lo % width, hi + 1, width):
                        low, high = max(lo, first), min(hi, first + width - 1)
                        if width > 1:
                            cores.append(short(text[s - first:s - first - width + 1 + length], first))
                        hashes.append(wide(text[s - high:s - low + length], low << 32 | high))
                        told.append((run, low, high))
                if len(told) >= 1 << 16:
                    yield _cells(cores, hashes, told)
                    cores, hashes, told = [], [], []
            if told:
                yield _cells(cores, hashes, told)

    return rows


def _cells(cores: list[bytes], hashes: list[bytes], told: list[tuple[int, int, int]]) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
    core = np.frombuffer(b"".join(cores), np.int64) if cores else np.zeros(len(told), np.int64)
    columns = [core, halves[:, 0], halves[:, 1], *np.array(told, np.int64).T]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns],
                                      ["core", "h1", "h2", "id", "lo", "hi"])


def _twice(texts: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """(id, lo, hi): the parts of ``runs`` (id, k, s, lo, hi), no two alike, whose windows other runs have too."""
    def cells(parts: DataFrame, width: int) -> DataFrame:
        asked = parts.groupBy("k").agg(F.collect_list(F.struct("s", "lo", "hi", "id")).alias("parts"))
        return settle(texts.select("k", "text").join(asked.hint("merge"), "k").select("text", "parts")
                      .mapInArrow(_cell_rows(length, width), CELLS), "cells")

    wide = cells(runs, min(CELL, length))
    # Like cells have one range, so the id may be that of any.
    kinds = settle(wide.groupBy("core", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("id", "lo", "hi")]), "kinds")
    whole = wide.join(kinds.filter("n > 1").select("core", "h1", "h2"), ["core", "h1", "h2"], "left_semi")
    partly = settle(kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("core"),
                    "partly")
    # One cell of each kind stands for all: its windows tell those of other kinds.
    open_ = kinds.join(partly, "core", "left_semi").select("id", "lo", "hi").join(runs.select("id", "k", "s"), "id")
    single = cells(open_, 1)
    twice = settle(single.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"),
                   "twice")
    return whole.select("id", "lo", "hi").union(
        single.join(twice, ["h1", "h2"], "left_semi").select("id", "lo", "hi"))


def _cut(texts: pa.Array, spans: pa.Array, all_: pa.Array) -> pa.Array:
    """Bytes, removed bytes, removed runs, SHA-256 of the rest, and the runs."""
    import hashlib

    out = []
    for text, given, gone in zip(utf8(texts), spans.to_pylist(), all_.to_pylist(), strict=True):
        runs: list[list[int]] = []
        for s in sorted((s["a"], s["b"]) for s in given or []) if not gone else [(0, len(text))]:
            if runs and s[0] <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], s[1])
            else:
                runs.append(list(s))
        kept, at = hashlib.sha256(), 0
        for a, b in runs:
            kept.update(text[at:a])
            at = b
        kept.update(text[at:])
        out.append({"n_bytes": len(text), "n_removed": sum(b - a for a, b in runs), "n_spans": len(runs),
                    "kept_sha256": kept.hexdigest(), "runs": [{"a": a, "b": b} for a, b in runs]})
    return pa.array(out, pa.struct([
        ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("runs", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))]))


CUT = ("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string,"
       "runs:array<struct<a:bigint,b:bigint>>>")


def repeats(docs: DataFrame, length: int = LENGTH, margin: int = MARGIN,
            batches: int = BATCHES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and runs (byte ranges).

    Every byte inside a string of ``length`` bytes that starts anywhere else too
    is removed. Null text is empty; texts shorter than ``length`` keep all. Equal
    texts are one text with a count: of two or more, all is removed if they are
    long enough. Repeated rows are equal texts. An empty table gives an empty
    table. Other columns are not read.
    """
    if length < 2 * margin + HEAD:
        raise ValueError("the length must leave room between the margins")
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("k"),
                        F.coalesce("text", F.lit("")).alias("text"))
    texts = _bucketed(keyed.groupBy("k").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    long_ = texts.filter(F.octet_length("text") >= length)

    with settled_for_now(spark):
        named = settle(long_.select("k", "text").mapInArrow(_name_rows(length, margin), NAMED), "named")
        index = SuffixIndex(spark)
        part = F.pmod(F.xxhash64("k"), F.lit(batches))
        met = None
        for b in range(batches):
            found = index.add(named.filter(part == b))
            met = found if met is None else met.union(found)
        suspects = _kept(named.join(met.distinct(), ["head", "around"], "left_semi"), "suspects")
    _drop_shuffles(spark)
    runs = settle(suspects.groupBy("head", "around", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "start", "windows", "at")).alias("one"))
        .withColumn("id", F.monotonically_increasing_id()), "runs")
    whole = (suspects.join(runs.filter("n > 1").select("head", "around", "run"),
                           ["head", "around", "run"], "left_semi")
             .select("k", F.col("start").alias("a"), (F.col("start") + F.col("windows") - 1 + length).alias("b")))

    with settled_for_now(spark):
        # Runs that share a suffix but are not the same have their windows compared.
        # Such groups are settled first, so that joins see plain shuffles, whose skew Spark can split.
        differ = settle(runs.groupBy("head", "around").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
                        .select("head", "around"), "differ")
        placed = settle(runs.join(differ, ["head", "around"], "left_semi").select(
            "id", "one.k", (F.col("one.start") + F.col("one.at")).alias("s"),
            (F.col("one.at") - F.col("one.windows") + 1).alias("lo"), F.col("one.at").alias("hi"), "n"), "placed")
        _drop_shuffles(spark)
        single = _kept(_twice(texts, placed.drop("n"), length)
                       .join(placed.filter("n = 1").select("id", "k", "s"), "id")
                       .select("k", (F.col("s") - F.col("hi")).alias("a"),
                               (F.col("s") - F.col("lo") + length).alias("b")), "single")
    _drop_shuffles(spark)
    # A document's places are bounded by its length.
    spans = single.union(whole).groupBy("k").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    gone = (F.col("copies") > 1) & (F.octet_length("text") >= length)
    cut = settle(texts.join(spans.hint("merge"), "k", "left")
                 .select("k", F.arrow_udf(_cut, CUT)("text", "spans", gone).alias("c"))
                 .select("k", "c.*"), "cut")
    return keyed.select("doc_id", "k").join(cut.hint("merge"), "k").drop("k")


def _kept(df: DataFrame, label: str) -> DataFrame:
    """Written like a settled table, but not removed with those of the step."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps; it waits for a collection."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def _bucketed(texts: DataFrame) -> DataFrame:
    """``texts`` written in buckets of k, so that joins on k need not move them again.

    There are as many buckets as shuffle partitions, so the grouping that made
    ``texts`` has dealt them already.
    """
    spark = texts.sparkSession
    path = fresh_dir(spark, "texts")
    name = "texts_" + path.rsplit("-", 1)[-1]
    (texts.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "k").option("path", path)
     .option("compression", "zstd").saveAsTable(name))
    _drop_shuffles(spark)
    return spark.table(name)
