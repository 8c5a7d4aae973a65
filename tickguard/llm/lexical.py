"""Ranked lexical search by groups of equal term masks.

One pass over the documents keeps, of each, its number of terms and how often the terms
of the queries occur. In a segment of documents each of an item's terms sets its bit in
the masks of the documents that hold it, and documents are grouped by equal masks. The most
that a mask can score is the sum of its terms' greatest scores in the segment, so the
distinct masks are evaluated from the highest such sum down, until the next one lies below
the last document that would still be returned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tickguard.llm.common import utf8
from tickguard.session import settle

TOP = 50
SEGMENT = 8192            # documents whose bitmaps are held at once
BLOCK_TERMS = 200_000     # terms of items that are searched in one go: bounds what is broadcast
#: Fixed values of the score: how a document's length counts, and how fast repeats of a term saturate.
FLAT, SLOPE, SOFTEN = 50, 50, 20
BATCH = 64                # documents that are scored together at least

_SPACE = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256))
HELD = "struct<n:bigint,terms:array<int>,tfs:array<bigint>>"
FOUND = "item long, doc_id {id}, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and everything beyond ASCII; only A-Z are lower-cased."""
    return text.translate(_SPACE).split()


def _distinct_terms(texts: pa.Array) -> pa.Array:
    return pa.array([sorted(set(terms_of(t))) for t in utf8(texts)], pa.list_(pa.binary()))


def _held(shared):
    """A function on texts: the number of terms, and the query terms among them with their counts."""
    @F.arrow_udf(HELD)
    def held(texts: pa.Array) -> pa.Array:
        known = shared.value
        n, terms, tfs, ends = [], [], [], [0]
        for text in utf8(texts):
            words = terms_of(text)
            counts = Counter(map(known.get, words, repeat(-1)))
            counts.pop(-1, None)
            n.append(len(words))
            terms.extend(counts.keys())
            tfs.extend(counts.values())
            ends.append(len(terms))
        ends = pa.array(ends, pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
             pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], ["n", "terms", "tfs"])

    return held


class Segment:
    """The query terms of some documents: places and scores per term, and bitmaps over the documents."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, shared: dict):
        self.count = len(n)
        docs = np.repeat(np.arange(self.count), sizes)
        spread = FLAT + (SLOPE * n * shared["N"]) // max(shared["L"], 1)
        parts = (1_000_000_000 * tfs) // (1000 * tfs + SOFTEN * spread[docs])
        order = np.argsort(terms, kind="stable")
        terms, docs, parts = terms[order], docs[order], parts[order] * shared["weights"][terms[order]]
        held, begins = np.unique(terms, return_index=True)
        ends = np.append(begins[1:], len(terms))
        self.places = {t: (docs[a:b], parts[a:b]) for t, a, b in zip(
            held.tolist(), begins.tolist(), ends.tolist(), strict=True)}
        self.most = {t: int(parts.max()) for t, (_, parts) in self.places.items()}

    def groups(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents ordered by the greatest score of their mask, where each mask's documents begin, and that score."""
        masks = np.zeros((self.count, -(-len(terms) // 64)), np.uint64)
        for i, term in enumerate(terms):
            masks[self.places[term][0], i // 64] |= np.uint64(1 << i % 64)
        some = np.flatnonzero(masks.any(axis=1))
        masks = masks[some]
        by = np.lexsort(masks.T)
        masks, some = masks[by], some[by]
        new = np.ones(len(some), bool)
        new[1:] = (masks[1:] != masks[:-1]).any(axis=1)
        begins = np.flatnonzero(new)
        distinct = masks[begins]
        most = np.zeros(len(begins), np.int64)
        for i, term in enumerate(terms):
            most += ((distinct[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64) * self.most[term]
        sizes = np.diff(np.append(begins, len(some)))
        order = np.argsort(-most, kind="stable")
        begins, sizes, most = begins[order], sizes[order], most[order]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.zeros(0, np.int64)
        take = np.repeat(begins - starts, sizes) + np.arange(len(some))
        return some[take], starts, most

    def score(self, terms: list[int], docs: np.ndarray) -> np.ndarray:
        total = np.zeros(len(docs), np.int64)
        for term in terms:
            places, parts = self.places[term]
            at = np.minimum(np.searchsorted(places, docs), len(places) - 1)
            total += np.where(places[at] == docs, parts[at], 0)
        return total

    def best(self, terms: list[int], top: int, ground: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the first ``top``, with their scores, none below ``ground``."""
        terms = [t for t in terms if t in self.places]
        if not terms:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, starts, most = self.groups(terms)
        ends = np.append(starts[1:], len(docs))
        picked, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        k, batch = 0, BATCH
        while k < len(starts) and most[k] >= ground and most[k] > 0:
            last = min(len(starts), int(np.searchsorted(ends, starts[k] + batch)) + 1)
            last = min(last, k + int(np.searchsorted(-most[k:], -max(ground, 1), side="right")))
            here = docs[starts[k]:ends[last - 1]]
            found = self.score(terms, here)
            keep = (found >= ground) & (found > 0)
            picked, scores = np.append(picked, here[keep]), np.append(scores, found[keep])
            if len(scores) > top:
                ground = max(ground, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
                keep = scores >= ground
                picked, scores = picked[keep], scores[keep]
            k, batch = last, batch * 2
        return picked, scores


def _search(shared, top: int, id_type: pa.DataType):
    schema = pa.schema([("item", pa.int64()), ("doc_id", id_type), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best documents of a partition; a list is cut only among documents of lower scores."""
        items = shared.value["items"]
        ids = [pa.array([], id_type)] * len(items)
        scores = [np.zeros(0, np.int64)] * len(items)
        ground = [0] * len(items)
        for batch in batches:
            for at in range(0, batch.num_rows, SEGMENT):
                part = batch.slice(at, SEGMENT)
                terms = part.column("terms")
                segment = Segment(
                    part.column("n").to_numpy(), terms.value_lengths().to_numpy(zero_copy_only=False),
                    terms.flatten().to_numpy(zero_copy_only=False),
                    part.column("tfs").flatten().to_numpy(zero_copy_only=False), shared.value)
                names = part.column("doc_id")
                for i, item in enumerate(items):
                    docs, found = segment.best(item, top, ground[i])
                    if len(docs):
                        ids[i] = pa.concat_arrays([ids[i], names.take(pa.array(docs))])
                        scores[i] = np.append(scores[i], found)
                        ids[i], scores[i] = _first(ids[i], scores[i], top)
                        if len(scores[i]) == top:
                            ground[i] = int(scores[i][-1])
        for i, name in enumerate(shared.value["rows"]):
            if len(scores[i]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(scores[i]), pa.int64()), ids[i], pa.array(scores[i])], schema=schema)

    return search


def _first(ids: pa.Array, scores: np.ndarray, top: int) -> tuple[pa.Array, np.ndarray]:
    table = pa.table({"id": ids, "score": scores}).sort_by([("score", "descending"), ("id", "ascending")])[:top]
    return table["id"].combine_chunks(), table["score"].to_numpy()


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score: for each of ``items`` (item_id, text) its best ``docs`` (doc_id, text).

    A term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), a document's length n counts as
    m = 50 + 50 * n * N div L, and a document scores the sum of w * (10^9 * tf div (1000 * tf + 20 * m))
    over the item's distinct terms: N documents with a term, L terms in all, df documents with
    the term. Documents of score zero are not found. Null and empty texts have no
    terms: such documents are never found and do not count, such items find nothing. Every
    row of ``docs`` is a document of its own, repeated rows and ids too; among equal scores a
    null id comes last. Rows of ``items`` with the same id, null included, are one item, which
    has the terms of them all. Texts of any length are read whole; other columns are not read.
    Items are searched in blocks of a bounded number of terms. An empty table on either side
    gives an empty result.
    """
    spark = docs.sparkSession
    terms = (items.select("item_id", F.explode(F.arrow_udf(_distinct_terms, "array<binary>")("text")).alias("term"))
             .distinct())
    terms = settle(terms, "item-terms")
    blocks = 1 + terms.count() // BLOCK_TERMS
    named = settle(terms.select("item_id").distinct().select(
        "item_id", F.monotonically_increasing_id().alias("item"),
        F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block")), "items")
    same = terms["item_id"].eqNullSafe(named["item_id"])
    terms = settle(terms.join(named, same).select("item", "block", "term"), "item-terms")
    found, id_type = None, docs.schema["doc_id"].dataType.simpleString()
    for block in range(blocks):
        rows = terms.filter(F.col("block") == block).select("item", "term").collect()
        known: dict[bytes, int] = {}
        wanted: dict[int, list[int]] = {}
        for row in rows:
            wanted.setdefault(row.item, []).append(known.setdefault(bytes(row.term), len(known)))
        vocabulary = spark.sparkContext.broadcast(known)
        held = settle(docs.select("doc_id", _held(vocabulary)("text").alias("h"))
                      .select("doc_id", "h.n", "h.terms", "h.tfs").filter("n > 0"), "held")
        count, length = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        spread = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weigh = F.floor(1000 * F.log(F.lit(2.0 * count + 2) / (2 * F.col("df") + 1).cast("double"))).alias("w")
        weights = np.zeros(len(known), np.int64)
        for row in spread.select("term", weigh).collect():
            weights[row.term] = row.w
        shared = spark.sparkContext.broadcast({
            "rows": list(wanted), "items": list(wanted.values()), "weights": weights, "N": count, "L": length})
        best = held.filter(F.size("terms") > 0).mapInArrow(
            _search(shared, top, to_arrow_type(held.schema["doc_id"].dataType)), FOUND.format(id=id_type))
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")

