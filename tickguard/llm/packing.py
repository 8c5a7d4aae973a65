"""Packing token sequences by best-fit decreasing, for any number of documents.

Best-fit decreasing looks at lengths only, and there are no more lengths than
tokens in a window. So the driver plans on counts per length, with a segment tree
over remaining capacities, and gets runs: "pieces 0 to 99 of length 700 go to
windows 40 to 139 at offset 1300". The pieces are numbered within their length and
look up their run. Nothing that the driver holds grows with the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress, pairwise
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickguard.session import settle

END = 1
SIZE = 2048
CHUNK_CACHE = 1 << 19
WORDS_AT_ONCE = 1 << 14
GROUP_CHARS = 1 << 21     # characters of texts that are cut together
MARKS = b".,;:!?#*$%&|)]}\"-_+=/"
RANK_ROWS = 10_000        # pieces of one length that one task numbers

PIECE = "struct<start:bigint,length:bigint,ids_crc32:bigint,ids:binary>"


def tokenized(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False,
              cached: int = CHUNK_CACHE) -> DataFrame:
    """``docs`` with ``_doc_tokens`` and ``_pieces``: the ids and an end mark, cut into full windows.

    Only the last piece is shorter than ``size``. A text is cut at ASCII white
    space, which is never part of a token here, and the ids of the stretches are
    kept in a cache of ``cached`` entries; fewer only cost time. Null is an empty text: one piece, the end mark.
    """
    @F.arrow_udf(f"struct<doc_tokens:bigint,pieces:array<{PIECE}>>")
    def cut(texts: pa.Array) -> pa.Array:
        encode = Encoder.of(path, cached)
        counts, pieces = [], []
        for group in _groups(texts.to_pylist()):
            for ids in map(memoryview, encode(group)):
                counts.append(len(ids) // 4)
                pieces.append([{
                    "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part),
                    "ids": bytes(part) if with_ids else None}
                    for at in range(0, len(ids), 4 * size) for part in [ids[at:at + 4 * size]]])
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()),
                          ("ids_crc32", pa.int64()), ("ids", pa.binary())])
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(pieces, pa.list_(kind))], ["doc_tokens", "pieces"])

    # Not deterministic to the optimizer: else it is run once for each field that is read.
    return (docs.withColumn("_cut", cut.asNondeterministic()("text"))
            .withColumns({"_doc_tokens": F.col("_cut.doc_tokens"), "_pieces": F.col("_cut.pieces")})
            .drop("_cut"))


def _groups(texts: list[str | None]) -> Iterator[list[str]]:
    held, chars = [], 0
    for t in texts:
        held.append(t or "")
        chars += len(held[-1])
        if chars >= GROUP_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


_ENCODERS: dict[tuple[str, int], Encoder] = {}


class Encoder:
    """texts -> their ids and the end mark, little-endian 32 bits each.

    ASCII white space is never part of a token, so texts are cut there and the
    ids of the stretches, and of the words in them, are kept; before new ones would
    make them more than ``cached``, all go. New stretches that are letters and then punctuation are words to the tokenizer; their letters are
    encoded many at once, and the ids are told apart by the word ends among them.
    The tokenizer encodes all other stretches one by one, and texts that may hold
    its special tokens as a whole.
    """

    def __init__(self, path: str, cached: int = CHUNK_CACHE):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cached = cached
        self.known: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str, cached: int = CHUNK_CACHE) -> Encoder:
        if (path, cached) not in _ENCODERS:
            _ENCODERS[path, cached] = cls(path, cached)
        return _ENCODERS[path, cached]

    def __call__(self, texts: list[str]) -> list[bytes]:
        end = END.to_bytes(4, "little")
        cut = [[] if "<|" in t else t.encode().lower().split() for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > self.cached:
            self.known.clear()
            new = set().union(*cut)
        self._learn(new)
        get = self.known.__getitem__
        return [(b"".join(map(get, chunks)) if "<|" not in t else self._ids([t])[0]) + end
                for t, chunks in zip(texts, cut, strict=True)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def _learn(self, new: set[bytes]) -> None:
        chunks = list(new)
        words = [c.rstrip(MARKS) for c in chunks]
        # No chunk has a space, so all are decoded at once.
        simple = [t.isalpha() or not t for t in b" ".join(words).decode().split(" ")] if chunks else []
        self._learn_whole([c for c, s in zip(chunks, simple, strict=True) if not s])
        chunks, words = (list(compress(x, simple)) for x in (chunks, words))
        tails = [c[len(w):] for c, w in zip(chunks, words, strict=True)]
        self.known[b""] = b""
        unknown = list(set(words).difference(self.known))
        for at in range(0, len(unknown), WORDS_AT_ONCE):
            self._learn_words(unknown[at:at + WORDS_AT_ONCE])
        self._learn_whole(list(set(tails).difference(self.known)))
        get = self.known.__getitem__
        self.known.update(zip(chunks, map(add, map(get, words), map(get, tails)), strict=True))

    def _learn_whole(self, chunks: list[bytes]) -> None:
        self.known.update(zip(chunks, self._ids([c.decode() for c in chunks]), strict=True))

    def _learn_words(self, words: list[bytes]) -> None:
        [made] = self._ids([b" ".join(words).decode()])
        ends = np.flatnonzero(self.ends[np.frombuffer(made, "<u4")]) * 4 + 4
        if len(ends) != len(words):        # some word is several to the tokenizer
            self._learn_whole(words)
            return
        places = [0, *ends.tolist()]
        self.known.update(zip(words, [made[a:b] for a, b in pairwise(places)], strict=True))


class OpenWindows:
    """Windows with room, by how much: a segment tree finds the tightest that fits."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = [False] * (2 * self.leaves)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]   # (first, count)

    def put(self, room: int, first: int, count: int) -> None:
        if count and room:
            self.groups[room].append((first, count))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        got = self.groups[room].pop()
        self._mark(room)
        return got

    def _mark(self, room: int) -> None:
        at = self.leaves + room
        self.some[at] = bool(self.groups[room])
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need``."""
        at = self.leaves + need
        if not self.some[at]:
            while at > 1 and (at % 2 or not self.some[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first piece, pieces, first window, offset): one window each, in order.

    ``counts`` has the pieces of each length. The result is that of best-fit
    decreasing piece by piece: a window that takes a piece is the tightest for the
    next equal one while it still fits.
    """
    open_, runs, windows = OpenWindows(size), [], 0
    for length in sorted(counts, reverse=True):
        piece, left = 0, counts[length]
        while left:
            room = open_.tightest(length)
            if room is None:
                room, first, have = size, windows, -(-left // (size // length))
                windows += have
            else:
                first, have = open_.take(room)
            each = room // length
            full = min(have, left // each)
            rest = min(each, left - full * each) if full < have else 0
            for k in range(each):
                if full:
                    runs.append((length, piece, full, first, size - room + k * length))
                    piece += full
            open_.put(room - each * length, first, full)
            for k in range(rest):
                runs.append((length, piece, 1, first + full, size - room + k * length))
                piece += 1
            if rest:
                open_.put(room - rest * length, first + full, 1)
            used = full + (rest > 0)
            open_.put(room, first + used, have - used)
            left -= full * each + rest
    return runs


def pack(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False,
         cached: int = CHUNK_CACHE) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, ids, doc_tokens, sequence_id, offset.

    Every id of every document lies in one piece; a sequence holds at most
    ``size`` ids. ``ids`` (four little-endian bytes each) is null unless asked
    for. An empty or null text is one end mark. Repeated rows are packed one
    by one; an empty table gives no pieces. Other columns are not read.
    """
    spark = docs.sparkSession
    pieces = settle(
        tokenized(docs.select("doc_id", "text"), path, size, with_ids, cached)
        .select("doc_id", F.col("_doc_tokens").alias("doc_tokens"), F.inline("_pieces"))
        .withColumn("deal", F.xxhash64("doc_id", "start", "ids_crc32")), "pieces")
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = spark.createDataFrame(
        plan(counts, size) or [(0, 0, 0, 0, 0)],
        "length bigint, first_piece bigint, pieces bigint, first_window bigint, at bigint")

    # Pieces of a length are numbered in buckets; the buckets' counts give each its first number.
    buckets = 1 + sum(counts.values()) // RANK_ROWS
    dealt = pieces.withColumn("bucket", F.pmod("deal", F.lit(buckets)))
    first = dealt.groupBy("length", "bucket").count().select(
        "length", "bucket", (F.sum("count").over(
            Window.partitionBy("length").orderBy("bucket")) - F.col("count")).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("deal", "doc_id", "start")
    number = F.col("before") + F.col("turn") - 1
    numbered = (dealt.withColumn("turn", F.row_number().over(order))
                .join(first, ["length", "bucket"])
                .withColumn("number", number).drop("turn", "before", "bucket", "deal"))
    # The plan's runs are bounded by the window size: a few thousand rows.
    inside = (F.col("number") >= F.col("first_piece")) & (
        F.col("number") < F.col("first_piece") + F.col("pieces"))
    placed = numbered.join(F.broadcast(runs.withColumnRenamed("length", "of")),
                           (F.col("length") == F.col("of")) & inside)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "ids", "doc_tokens",
        (F.col("first_window") + F.col("number") - F.col("first_piece")).alias("sequence_id"),
        F.col("at").alias("offset"))
