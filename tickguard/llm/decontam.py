"""Benchmark decontamination with a generalised suffix automaton of the items.

Documents stream through the automaton word by word; it tells the longest run of
words up to here that some item holds. Runs as long as a window are hits. Words
outside the items, or pairs of neighbours that no item has, end every run, so the
automaton only walks the stretches between them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickguard.llm.common import utf8
from tickguard.session import settle

WINDOW = 10
MAX_COVERAGE = 0.5        # documents of which more is hit are dropped whole
BLOCK_WORDS = 500_000     # words of items in one automaton: bounds what is broadcast

_SPACE = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, a-z and everything beyond ASCII."""
    return text.translate(_SPACE).split()


class Automaton:
    """All runs of words of the items, with the windows that count and the items they belong to."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], set[str]] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        pairs: set[tuple[int, int]] = set()
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)]
            if not words:
                continue
            last = 0
            for w in words:
                last = self._extend(last, w)
            pairs.update(zip(words, words[1:], strict=False))
            size = min(window, len(words))
            for i in range(len(words) - size + 1):
                of = self.windows.setdefault(tuple(words[i:i + size]), set())
                if item is not None:
                    of.add(item)
        self.sizes = sorted({len(w) for w in self.windows})
        self.pairs = np.unique(np.array([a << 32 | b for a, b in pairs] or [-1], np.int64))

    def _extend(self, last: int, w: int) -> int:
        """The state of the item's run, longer by ``w``."""
        if w in self.next[last]:
            old = self.next[last][w]
            return old if self.length[old] == self.length[last] + 1 else self._split(last, w, old)
        new = self._state({}, 0, self.length[last] + 1)
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at >= 0:
            old = self.next[at][w]
            self.link[new] = old if self.length[old] == self.length[at] + 1 else self._split(at, w, old)
        return new

    def _state(self, after: dict[int, int], link: int, length: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, w: int, old: int) -> int:
        copy = self._state(dict(self.next[old]), self.link[old], self.length[at] + 1)
        self.link[old] = copy
        while at >= 0 and self.next[at].get(w) == old:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def _stretches(self, ids: np.ndarray):
        """(from, to) of runs of words in which any two neighbours are neighbours in an item too."""
        least = self.sizes[0]
        joined = (ids[:-1] >= 0) & (ids[1:] >= 0)
        at = np.flatnonzero(joined)
        pairs = ids[at].astype(np.int64) << 32 | ids[at + 1]
        spot = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        joined[at[self.pairs[spot] != pairs]] = False
        edges = np.diff(np.concatenate(([0], joined, [0])).astype(np.int8))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + 1
        for a, b in zip(begins, ends, strict=True):
            if b - a >= least:
                yield int(a), int(b)
        if least == 1:
            alone = ids >= 0
            alone[1:] &= ~joined
            alone[:-1] &= ~joined
            for a in np.flatnonzero(alone):
                yield int(a), int(a) + 1

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words, from and to, and the items whose windows occur."""
        if not self.sizes or not words:
            return [], set()
        get = self.ids.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        for a, b in self._stretches(ids):
            state = matched = 0
            stretch = ids[a:b].tolist()
            for i, w in enumerate(stretch, a + 1):
                while state and w not in self.next[state]:
                    state = self.link[state]
                    matched = self.length[state]
                if w in self.next[state]:
                    state, matched = self.next[state][w], matched + 1
                for size in self.sizes:
                    if size > matched:
                        break
                    if (found := self.windows.get(tuple(stretch[i - a - size:i - a]))) is not None:
                        items |= found
                        runs.append((i - size, i))
        return _union(runs), items


def _union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


FOUND = "struct<n_words:bigint,runs:array<struct<a:bigint,b:bigint>>,items:array<string>>"
RUN = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def _search(spark: SparkSession, automaton: Automaton):
    shared = spark.sparkContext.broadcast(automaton)

    @F.arrow_udf(FOUND)
    def search(texts: pa.Array) -> pa.Array:
        counts, runs, items = [], [], []
        for text in utf8(texts):
            words = words_of(text)
            hit, of = shared.value.hits(words)
            counts.append(len(words))
            runs.append([{"a": a, "b": b} for a, b in hit])
            items.append(sorted(of))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(runs, pa.list_(RUN)),
             pa.array(items, pa.list_(pa.string()))], ["n_words", "runs", "items"])

    return search


MERGED = "struct<runs:array<struct<a:bigint,b:bigint>>,n_hit:bigint>"


def _merged(lists: pa.Array) -> pa.Array:
    runs = [_union([(r["a"], r["b"]) for r in one or []]) for one in lists.to_pylist()]
    return pa.StructArray.from_arrays(
        [pa.array([[{"a": a, "b": b} for a, b in r] for r in runs], pa.list_(RUN)),
         pa.array([sum(b - a for a, b in r) for r in runs], pa.int64())], ["runs", "n_hit"])


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_hit``, ``_runs`` (word ranges) and ``_items`` (ids as text).

    ``items`` has item_id and text. They are searched in blocks of a bounded
    number of words, one automaton each. Null and empty texts have no words,
    and items without words no windows. Repeated rows are searched one by one,
    and repeated items count once for each id. An item without an id has hits like any
    other, but no name in ``_items``. Very long texts are searched whole, one at a time in a
    task. Other columns pass through.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // (4 * BLOCK_WORDS)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = docs.withColumn("_found", F.lit(None).cast("array<" + FOUND + ">"))
    for k in range(blocks):
        rows = items.filter(part == k).filter("text is not null").collect()
        search = _search(spark, Automaton([(r.item_id, r.text.encode()) for r in rows], window))
        here = F.array(search("text"))
        found = found.withColumn("_found", F.concat(F.coalesce("_found", F.array().cast(
            "array<" + FOUND + ">")), here) if k else here)
        if blocks > 1:
            found = settle(found, "found")
    runs = F.flatten(F.transform("_found", lambda f: f["runs"]))
    return (found.withColumn("_merged", F.arrow_udf(_merged, MERGED)(runs))
            .withColumns({"_n_words": F.col("_found")[0]["n_words"],
                          "_n_hit": F.col("_merged.n_hit"), "_runs": F.col("_merged.runs"),
                          "_items": F.array_distinct(F.flatten(
                              F.transform("_found", lambda f: f["items"])))})
            .drop("_found", "_merged"))


def _without(texts: pa.Array, runs: pa.Array) -> pa.Array:
    out = []
    for text, cut in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
        if cut:
            raw = text.encode()
            spans = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_SPACE))]
            kept, at = [], 0
            for r in cut:
                kept.append(raw[at:spans[r["a"]][0]])
                at = spans[r["b"] - 1][1]
            text = b"".join([*kept, raw[at:]]).decode()
        out.append(text)
    return pa.array(out, pa.string())


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW,
          max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without the hit runs, and without documents of which too much is hit.

    Runs of at least a window (or a whole shorter item) are cut out of the text;
    a document with more than ``max_coverage`` of its words hit goes. Documents
    without a hit, empty and null texts among them, stay as they are.
    """
    searched = settle(find(docs, items, window), "searched")
    hit = searched.filter(f"_n_hit > 0 and _n_hit <= {max_coverage} * _n_words")
    cut = hit.withColumn("text", F.arrow_udf(_without, "string")("text", "_runs"))
    return searched.filter("_n_hit = 0").unionByName(cut).select(*docs.columns)
