"""Exact Jaccard self-join of word shingles by pigeonhole over parts of the universe.

Shingles are hashed into the segments of a size band. Two sets as similar as wanted differ
in at most H shingles, H following from their sizes, so if the probing set allots its
segments H + 1 in all, with one for a segment that must agree and two for one that may also
differ by one shingle, some allotted segment is met. The index holds every segment of a
set, and of a few segments every subset with one shingle less; a probe looks up the same
subsets of its own. Probes allot by cost: a mergeable count sketch of the index entries that
a task sees repeatedly tells which segments are frequent, and these are left out as far as
the sum allows.

Equal sets are one class. Of every set there is a parity word: its shingles are dealt over
1,024 bits, each of which is flipped by every shingle it gets. Two parity words differ in at most as
many bits as their sets differ in shingles, so bits beyond what similar sets may differ in rule a pair
out for certain. Entries without a partner that passes this are left out first; that thins crowds
whose members resemble each other, but not enough.

Classes that meet are then tested against one other class of each bucket, chosen by the
number of meetings, round by round between groups that are not linked yet; that joins crowds
of near copies without pairing them all. Then all pairs that still meet across groups, are
not ruled out, and meet often enough for their sizes, are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tickguard.llm.common import utf8
from tickguard.llm.simhash import components
from tickguard.operators.attach import attach
from tickguard.session import settle

SIZE, PERCENT = 5, 80
SKETCH = 1 << 17           # counters in each of the two rows of the sketch
SHRUNK = 4                 # segments of a band whose subsets are indexed, beyond the small bands
HOT = 20_000               # entries of a bucket from which its rows are salted
SALTS = 64
SIEVE = 1 << 28            # most bits of the sieve that tells which sets are needed
LONG_WORD = 256            # bytes
CELL = 512                 # classes of either end whose pairs are verified together
REPEATED = 1 << 20         # index entries of a task among which the sketch looks for repeated ones
PIECE = 1 << 22            # bytes of a text that are hashed at once
PROGRESS = 0.1             # share of tests that must link for another round
FEW = 256                  # tests up to which that are linked are no reason for another round
PARITY = 16                # 64-bit parts of a parity word

#: Roles of an entry: whole or shrunk segment in the index, probes that count one or two, a
#: probe with a shrunk segment; entries of frequent buckets are marked.
WHOLE, SHRINK, ONE, TWO, SHORT, FREQUENT = 1, 2, 4, 8, 16, 32
ROLE_BITS, SIZE_BITS = 6, 30
LAST = 1 << 62             # cost of empty segments, which very many sets share

_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S29, _S32 = np.uint64(29), np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S29)) * _P2
    return x ^ (x >> _S32)


_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64) * _P1)
_POWERS = np.cumprod(np.full(LONG_WORD, _P2 | np.uint64(1), np.uint64), dtype=np.uint64)


def _words(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words in lower-cased bytes: polynomials of their letters.

    Words of ``LONG_WORD`` bytes and more, on which such a polynomial could be
    led astray, are hashed on their own.
    """
    inside = ~_SPACES[raw]
    edged = np.zeros(len(raw) + 2, bool)
    edged[1:-1] = inside
    turns = np.flatnonzero(edged[1:] != edged[:-1])
    begins, sizes = turns[::2], turns[1::2] - turns[::2]
    if not len(begins):
        return np.zeros(0, np.uint64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    letters = _LETTERS[raw[inside]] * _POWERS[np.minimum(place, LONG_WORD - 1)]
    hashes = _mix(np.add.reduceat(letters, starts) + sizes.astype(np.uint64))
    for i in np.flatnonzero(sizes >= LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(raw[begins[i]:begins[i] + sizes[i]].tobytes())
    return hashes


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the lower-cased words in order; texts are read piece by piece, cut at white space."""
    raw = np.frombuffer(text.lower(), np.uint8)
    parts, at = [], 0
    while len(raw) - at > PIECE:
        end, reach = at, PIECE
        while end <= at < at + reach <= len(raw):
            spaces = np.flatnonzero(_SPACES[raw[at:at + reach]])
            end, reach = (at + int(spaces[-1]) + 1, reach) if len(spaces) else (at, 2 * reach)
        if end <= at:
            break
        parts.append(_words(raw[at:end]))
        at = end
    parts.append(_words(raw[at:]))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def shingles(text: bytes, size: int = SIZE) -> np.ndarray:
    """The distinct shingles of lower-cased words, as sorted 64-bit hashes."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ hashes[i:i + n]) * _P1
        out ^= out >> _S32
    out = np.sort(_mix(out))
    new = np.ones(n, bool)
    np.not_equal(out[1:], out[:-1], out=new[1:])
    return out[new]


class Scheme:
    """Size bands, their segments, and how many shingles similar sets may differ in."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.edges = [1]
        while self.edges[-1] < 1 << SIZE_BITS:
            self.edges.append(max(self.edges[-1] + 1, self.edges[-1] * 3 // 2))
        self._salts: dict[int, np.ndarray] = {}
        self._cuts: dict[int, np.ndarray] = {}

    def apart(self, a: int, b: int) -> int:
        """The most shingles in which sets of these sizes may differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size, side="right")) - 1

    def bands(self, size: int) -> list[int]:
        """Bands of the sets up to this size that may be similar to it; the last one is its own."""
        return list(range(self.band(-(-size * self.percent // 100)), self.band(size) + 1))

    @cache  # noqa: B019 - one scheme lives as long as its task
    def segments(self, band: int) -> tuple[int, int]:
        """Number of segments, and of those whose subsets are indexed."""
        need = self.apart(2 * (self.edges[band + 1] - 1), 0) + 1
        if need <= 4:
            few = -(-need // 2)
            return few, few
        return need + -(-need // 8), SHRUNK

    def cuts(self, band: int) -> np.ndarray:
        if band not in self._cuts:
            count = self.segments(band)[0]
            self._cuts[band] = np.array([(i << 64) // count for i in range(1, count)], np.uint64)
            steps = np.arange(count, dtype=np.uint64) + np.uint64(band << 40)
            self._salts[band] = _mix(_mix(steps * _P1) + _P2)
        return self._cuts[band]

    def keys(self, held: np.ndarray, marks: np.ndarray, sums: np.ndarray, band: int) -> tuple[
            np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys and sizes of the whole segments, keys of their subsets with one shingle less, and those subsets' segments."""
        cuts, shrunk = self.cuts(band), self.segments(band)[1]
        ends = np.concatenate(([0], np.searchsorted(held, cuts), [len(held)]))
        whole = sums[ends[1:]] - sums[ends[:-1]] + self._salts[band]
        sizes = np.diff(ends)
        of = np.repeat(np.arange(shrunk), sizes[:shrunk])
        return _mix(whole), sizes, _mix(whole[of] - marks[:ends[shrunk]]), of


def _sums(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    marks = _mix(held + _P1)
    return marks, np.concatenate((np.zeros(1, np.uint64), np.cumsum(marks, dtype=np.uint64)))


def _digest(held: np.ndarray, marks: np.ndarray, seed: int) -> tuple[int, int]:
    """128 bits that stand for a set; the first 64 name its class."""
    with np.errstate(over="ignore"):
        one = _mix(marks + np.uint64(seed)).sum(dtype=np.uint64) + np.uint64(len(held))
        two = (_mix(marks ^ _P2) * _P1).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _parity(held: np.ndarray) -> np.ndarray:
    """The parity word of a set: sets that differ in d shingles have words that differ in d bits at most."""
    bits = np.bincount((held & np.uint64(64 * PARITY - 1)).view(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _counters(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counters of keys in the two rows of the sketch."""
    mask = np.uint64(SKETCH - 1)
    return (keys & mask).view(np.int64), (keys >> np.uint64(40) & mask).view(np.int64) + SKETCH


def _count(counts: np.ndarray, keys: list[np.ndarray]) -> None:
    """Add those keys to the sketch that occur more than once; the others would only fill its counters."""
    found, times = np.unique(np.concatenate(keys), return_counts=True)
    for at in _counters(found[times > 1]):
        counts += np.bincount(at, times[times > 1], len(counts)).astype(np.int64)


def allot(one: np.ndarray, two: np.ndarray, need: int, cheap: float) -> np.ndarray:
    """0, 1 or 2 per segment, ``need`` in all at least, at low cost.

    ``one`` is the cost of each segment, ``two`` the further cost of the subsets of
    the first ones. Segments that cost ``cheap`` at most are all taken: more
    meetings are then asked of a pair.
    """
    costs = np.concatenate((one, np.maximum(one[:len(two)], two)))
    picked = np.argsort(costs, kind="stable")[:need]
    given = np.bincount(np.where(picked < len(one), picked, picked - len(one)), minlength=len(one))
    return np.maximum(given, one <= cheap)


PRINT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("check", pa.int64()),
                   ("counts", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))])
ENTRY = pa.schema([("key", pa.int64()), ("cls", pa.int64()), ("info", pa.int64())])
HELD = pa.schema([("cls", pa.int64()), ("held", pa.binary())])


def _prints(id_type: pa.DataType, size: int, percent: int, seed: int):
    schema = PRINT.set(0, pa.field("doc_id", id_type))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sizes and classes of the texts, and at the end the sketch of their repeated index entries."""
        scheme, counts, seen = Scheme(percent), np.zeros(2 * SKETCH, np.int64), set()
        keys: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            rows, words = [], []
            for text in utf8(batch.column("text")):
                held = shingles(text, size)
                marks, sums = _sums(held)
                words.append(_parity(held) if len(held) else None)
                rows.append((len(held), *(_digest(held, marks, seed) if len(held) else (None, None))))
                if len(held) and rows[-1][1] not in seen:
                    seen.add(rows[-1][1])
                    whole, _, less, _ = scheme.keys(held, marks, sums, scheme.band(len(held)))
                    keys += [whole, less]
                    waiting += len(whole) + len(less)
                    if waiting >= REPEATED:
                        _count(counts, keys)
                        keys, waiting = [], 0
            n, cls, check = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                 pa.array(check, pa.int64()), pa.nulls(len(rows), pa.list_(pa.int64())),
                 pa.array(words, pa.list_(pa.int64()))], schema=schema)
        if keys:
            _count(counts, keys)
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.array([None], pa.int64()), pa.array([None], pa.int64()),
                 pa.array([None], pa.int64()), pa.array([counts], pa.list_(pa.int64())),
                 pa.nulls(1, pa.list_(pa.int64()))], schema=schema)

    return prints


def _entries(shared, size: int, percent: int, seed: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The index entries and probes of the texts; of copies in one task, those of the first."""
        scheme, counts, seen = Scheme(percent), shared.value, set()
        mean = counts.sum() / len(counts)
        cheap, hot = 16 + 2 * mean, max(HOT, 8 * mean)

        def cost(keys: np.ndarray) -> np.ndarray:
            first, second = _counters(keys)
            return np.minimum(counts[first], counts[second])

        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            waiting = 0
            for text in utf8(batch.column("text")):
                held = shingles(text, size)
                marks, sums = _sums(held)
                n = len(held)
                if not n or (cls := _digest(held, marks, seed)[0]) in seen:
                    continue
                seen.add(cls)
                *lower, own = scheme.bands(n)
                for band in (own, *lower):
                    need = scheme.apart(n, min(n, scheme.edges[band + 1] - 1)) + 1
                    whole, sizes, less, of = scheme.keys(held, marks, sums, band)
                    one, short = np.where(sizes, cost(whole), LAST), cost(less)
                    two = np.bincount(of, short, minlength=scheme.segments(band)[1])
                    given = allot(one, two, need, cheap)
                    roles = np.where(given == 1, ONE, np.where(given == 2, TWO, 0)) | (WHOLE if band == own else 0)
                    less_roles = np.where(given[of] == 2, SHORT, 0) | (SHRINK if band == own else 0)
                    roles = np.concatenate((roles, less_roles))
                    keys = np.concatenate((whole, less))
                    roles |= np.where(np.concatenate((cost(whole), short)) > hot, FREQUENT, 0)
                    told = roles & ~FREQUENT != 0
                    base = (int(given.sum()) << ROLE_BITS + SIZE_BITS) | n << ROLE_BITS
                    out.append((keys[told], np.full(told.sum(), cls, np.int64), base | roles[told]))
                    waiting += int(told.sum())
                if waiting > 100_000:
                    yield _batch(out)
                    out, waiting = [], 0
            if out:
                yield _batch(out)

    return entries


def _batch(out: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys, cls, info = (np.concatenate(part) for part in zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(cls), pa.array(info.astype(np.int64))],
                                      schema=ENTRY)


def _needed(sieve, size: int, seed: int):
    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sets whose class passes the sieve."""
        bits, seen = sieve.value, set()
        for batch in batches:
            names, sets = [], []
            for text in utf8(batch.column("text")):
                held = shingles(text, size)
                if not len(held):
                    continue
                cls = _digest(held, _mix(held + _P1), seed)[0]
                at = cls % (8 * len(bits))
                if bits[at >> 3] >> (at & 7) & 1 and cls not in seen:
                    seen.add(cls)
                    names.append(cls)
                    sets.append(held.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], schema=HELD)

    return needed


def _sieve(classes: DataFrame) -> np.ndarray:
    """A bitmap of bounded size in which every class (cls) has its bit."""
    bits, count = 1 << 16, classes.count()
    while bits < SIEVE and bits < 64 * count:
        bits *= 2
    words = classes.select(F.expr(f"pmod(cls, {bits}) div 32").alias("word"),
                           F.expr(f"shiftleft(1L, cast(pmod(cls, {bits}) % 32 as int))").alias("bit"))
    out = np.zeros(bits // 32, np.uint32)
    for batch in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _similar(percent: int):
    def similar(_, pairs: pa.Table, sets: pa.Table) -> pa.Table:
        """The similar ones among the pairs of a cell."""
        held = {c: np.frombuffer(h, np.uint64) for c, h in zip(
            sets["cls"].to_pylist(), sets["held"].to_pylist(), strict=True)}
        keep = []
        for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist(), strict=True):
            x, y = held[a], held[b]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                keep.append(False)
                continue
            both = np.concatenate((x, y))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= percent * (len(both) - common))
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return similar


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that are similar.

    Pairs are dealt over cells by a block of either end, and a set goes once to each cell
    that has a pair of it: a crowd of n classes moves n * n / CELL sets, not n * n.
    """
    blocks = 1 + sets.count() // CELL
    cell = (F.pmod(F.xxhash64("a"), F.lit(blocks)) * blocks + F.pmod(F.xxhash64("b"), F.lit(blocks))).alias("cell")
    dealt = pairs.select(cell, "a", "b")
    there = (dealt.select(F.col("cell").alias("place"), F.explode(F.array("a", "b")).alias("cls")).distinct()
             .join(sets, "cls"))
    return (dealt.groupBy("cell").cogroup(there.groupBy("place"))
            .applyInArrow(_similar(percent), "a long, b long"))


def _role(*bits: int) -> Column:
    return F.col("info").bitwiseAND(F.lit(sum(bits)).cast("long")) != 0


def _packed(name: str) -> Column:
    """What an entry's info tells of its class: the size, or the sum allotted."""
    return F.expr(f"(info >> {ROLE_BITS}) & {(1 << SIZE_BITS) - 1}" if name == "n"
                  else f"info >> {ROLE_BITS + SIZE_BITS}").alias(name)


def _apart(sizes: Column, percent: int) -> Column:
    """The most shingles in which two sets of these sizes together may differ."""
    return F.floor(sizes * (100 - percent) / (100 + percent))


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("cls"))
    return rows.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))


def _met(entries: DataFrame) -> DataFrame:
    """The entries of buckets in which a probe meets an index entry of another class.

    Frequent buckets are dealt over salts and kept whole.
    """
    salt = F.when(_role(FREQUENT), F.pmod("cls", F.lit(SALTS)) + 1).otherwise(0).cast("int")
    bucket = Window.partitionBy("key", "salt")
    roles = F.bit_or(F.col("info").bitwiseAND(F.lit((1 << ROLE_BITS) - 1).cast("long"))).over(bucket)
    found = entries.withColumn("salt", salt).withColumns(
        {"low": F.min("cls").over(bucket), "high": F.max("cls").over(bucket), "roles": roles})

    def has(*bits: int) -> Column:
        return F.col("roles").bitwiseAND(F.lit(sum(bits)).cast("long")) != 0

    meets = (F.col("low") != F.col("high")) & ((has(WHOLE) & has(ONE, TWO, SHORT)) | (has(SHRINK) & has(TWO)))
    return (found.filter(meets | (F.col("salt") > 0)).dropDuplicates(["key", "salt", "cls", "info"])
            .select("key", "cls", "info"))


def _promising(met: DataFrame, percent: int) -> DataFrame:
    """The entries without those of classes that meet others too seldom for any link.

    What a probe has allotted beyond what similar sets may differ in, it must meet. In
    its own band that holds for both ends of a link; of other bands' classes, those stay
    that share a bucket with such a probe from above.
    """
    told = met.select("*", _packed("n"), _packed("given"), _role(WHOLE, SHRINK).alias("own"))
    met_so_far = F.sum(F.when(_role(ONE), 1).when(_role(TWO, SHORT), 2).otherwise(0))
    enough = (told.groupBy("cls", "n", "given", "own").agg(met_so_far.alias("got"))
              .filter(F.col("got") >= F.col("given") - _apart(2 * F.col("n"), percent))
              .select("cls", "given", "own", F.lit(True).alias("enough")))
    told = settle(told.join(enough, ["cls", "given", "own"], "left").drop("n", "given"), "told")
    above = told.filter("enough and not own").select("key").distinct()
    seldom = told.filter("enough is null and own").join(above, "key", "left_semi")
    return told.filter("enough").unionByName(seldom).select("key", "cls", "info")


def _alike(met: DataFrame) -> DataFrame:
    """The entries of one of all buckets that have the same entries, and the number of these buckets as ``times``."""
    marks = [F.bit_xor(F.xxhash64("cls", "info", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    kept = (met.groupBy("key").agg(*marks).groupBy("mark0", "mark1")
            .agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("times")))
    return met.join(kept.select("key", "times"), "key")


def _worded(rows: DataFrame, words: DataFrame, cls: str = "cls", end: str = "") -> DataFrame:
    """``rows`` with the parity word of the class in ``cls``."""
    return rows.join(words.toDF(cls, *[f"p{i}{end}" for i in range(PARITY)]), cls)


def _possible(sizes: Column, percent: int) -> Column:
    """Whether the parity words p and p_x leave it open that sets of these sizes together are similar."""
    bits = [F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"p{i}_x"))) for i in range(PARITY)]
    return sum(bits[1:], bits[0]) <= _apart(sizes, percent)


def _partnered(met: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """The entries that share their bucket with one of another class that may be similar to theirs."""
    wide = _worded(met.select("*", _packed("n")), words)
    other = wide.select("key", *[F.col(c).alias(f"{c}_x") for c in ("cls", "n", *words.columns[1:])])
    sized = 100 * F.least("n", "n_x") >= percent * F.greatest("n", "n_x")
    same = wide["key"] == other["key"]
    return (wide.join(other, same & (F.col("cls") != F.col("cls_x")) & sized
                      & _possible(F.col("n") + F.col("n_x"), percent), "left_semi").select(*met.columns))


def link_classes(entries: DataFrame, sets_of, words_of, percent: int = PERCENT) -> DataFrame:
    """(cls, root) of classes that are linked to others, from their ``entries`` (key, cls, info).

    ``sets_of`` gives the sets (cls, held) of a table of classes, ``words_of`` their
    parity words (cls, p0, p1 ..).
    """
    met = settle(_promising(settle(_met(entries), "met"), percent), "met")
    met = settle(_alike(met), "alike")
    words = settle(words_of(met.select("cls").distinct()), "words")
    met = settle(_partnered(met, words, percent), "partnered")
    told = met.select("key", "cls", "times", _packed("n"), _packed("given"))
    sets = settle(sets_of(settle(met.select("cls").distinct(), "needed")).dropDuplicates(["cls"]), "sets")
    roots, tested, links = None, None, None

    while True:
        # Of each bucket, one class of the least group; classes of other groups that meet one often test it.
        now = _rooted(told, roots)
        turn = F.struct("root", F.xxhash64("cls", F.lit(0 if tested is None else len(tested.inputFiles()))))
        ends = (now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                       F.min_by(F.struct("cls", "n"), turn).alias("a")).filter("low <> high"))
        often = (now.join(ends, "key").filter("root <> low").groupBy(F.col("cls").alias("b"), F.col("a.cls").alias("a"))
                 .agg(F.sum("times").alias("times"), F.max("given").alias("given"), F.first("n").alias("n"),
                      F.first("a.n").alias("n_a"))
                 .filter(2 * F.col("times") >= F.col("given") - _apart(2 * F.col("n"), percent)))
        if tested is not None:
            often = often.join(tested, ["a", "b"], "left_anti")
        often = _worded(_worded(often, words, "b"), words, "a", "_x").filter(
            _possible(F.col("n") + F.col("n_a"), percent))
        pairs = settle(often.groupBy("b").agg(F.max_by("a", "times").alias("a")).select("a", "b"), "pairs")
        count = pairs.count()
        if not count:
            break
        found = settle(_verified(pairs, sets, percent), "links")
        new = found.count()
        tested = pairs if tested is None else tested.unionByName(pairs)
        if new:
            links = found if links is None else links.unionByName(found)
            roots = settle(components(links).withColumnsRenamed({"node": "cls"}), "roots")
        if new <= max(FEW, PROGRESS * count):
            break

    now = _rooted(met.select("*", _packed("n")), roots)
    mixed = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    now = _worded(settle(now.join(mixed.select("key"), "key"), "mixed"), words)
    x = now.filter(_role(WHOLE, SHRINK)).select(
        "key", *[F.col(c).alias(f"{c}_x") for c in ("cls", "root", "info", "n", *words.columns[1:])])
    y = now.filter(_role(ONE, TWO, SHORT))
    whole, shrunk = (F.expr(f"info_x & {bit} <> 0") for bit in (WHOLE, SHRINK))
    hits = (whole & _role(ONE, TWO, SHORT)) | (shrunk & _role(TWO))
    larger = (F.col("n_x") < F.col("n")) | ((F.col("n_x") == F.col("n")) & (F.col("cls_x") < F.col("cls")))
    near = (100 * F.col("n_x") >= percent * F.col("n")) & (F.col("root") != F.col("root_x")) & hits & larger
    met_x = (x["key"] == y["key"]) & near & _possible(F.col("n") + F.col("n_x"), percent)
    meetings = (x.join(y, met_x).groupBy(F.col("cls_x").alias("a"), F.col("cls").alias("b")).agg(
        F.sum(F.col("times") * F.when(_role(ONE), 1).otherwise(2)).alias("got"), F.first("n_x").alias("n_x"),
        F.first("n").alias("n"), F.max(_packed("given")).alias("given")))
    pairs = meetings.filter(F.col("got") >= F.col("given") - _apart(F.col("n") + F.col("n_x"), percent)).select("a", "b")
    if tested is not None:
        pairs = (pairs.join(tested, ["a", "b"], "left_anti")
                 .join(tested.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti"))
    found = settle(_verified(settle(pairs, "pairs"), sets, percent), "links")
    links = found if links is None else links.unionByName(found)
    return components(links).withColumnRenamed("node", "cls")


def similar_groups(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles and component_id, the least doc_id it is linked to.

    A document's set holds the distinct ``size``-word shingles of its whole text, or all its
    words as one where they are fewer; documents link where 100 * intersection >= ``percent`` *
    union, and links chain. Null, empty and wordless texts have an empty set, are linked with
    nothing and name themselves. Repeated rows and equal sets share their group. A null
    doc_id never names a group that has another. Very long texts are read whole, one at a
    time in a task. Other columns are not read; an empty table gives an empty table. Shingles
    are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, n long, cls long, check long, counts array<bigint>, parity array<bigint>"
    seed = 0
    while True:
        told = settle(docs.mapInArrow(_prints(to_arrow_type(id_type), size, percent, seed), schema), "prints")
        prints = told.filter("n is not null").drop("counts", "parity")
        classes = settle(prints.filter("n > 0").groupBy("cls").agg(
            F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"),
            (F.min("check") != F.max("check")).alias("clash")), "classes")
        if not classes.filter("clash").limit(1).count():
            break
        seed += 1                          # two sets under one name: name all anew
    counts = np.zeros(2 * SKETCH, np.int64)
    summed = told.filter("counts is not null").select(F.posexplode("counts").alias("at", "n")).filter(
        "n > 0").groupBy("at").agg(F.sum("n").alias("n"))
    for batch in summed.toArrow().to_batches():
        counts[batch.column("at").to_numpy()] = batch.column("n").to_numpy()
    shared = spark.sparkContext.broadcast(counts)
    entries = docs.select("text").mapInArrow(_entries(shared, size, percent, seed), "key long, cls long, info long")

    def sets_of(needed: DataFrame) -> DataFrame:
        sieve = spark.sparkContext.broadcast(_sieve(needed))
        return docs.select("text").mapInArrow(_needed(sieve, size, seed), "cls long, held binary")

    def words_of(needed: DataFrame) -> DataFrame:
        parts = [F.first(F.col("parity")[i]).alias(f"p{i}") for i in range(PARITY)]
        return told.filter("n > 0").join(needed, "cls", "left_semi").groupBy("cls").agg(*parts)

    linked = settle(link_classes(entries, sets_of, words_of, percent), "linked")
    named = classes.join(linked, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = settle(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("cls", "component_id", "copies")
    full = attach(prints.filter("n > 0"), named, ["cls"], "copies").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = prints.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)
