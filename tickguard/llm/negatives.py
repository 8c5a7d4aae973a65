"""Hard negatives of anchors, found with bounds along a spanning tree of the anchors.

Anchors lie in blocks of a bounded number, and every block has a minimum spanning
tree. A score at a tree parent, plus or minus the edge's length times the candidate's
norm, bounds the score at the child (Cauchy-Schwarz), so a slice of candidates walks
the tree from the root and only candidates whose bounds overlap an anchor's window are
scored there. The first walk finds the positives among the rows of the anchor's label,
the second one the negatives in the windows that the positives' scores open.

Anchors are a stated part of the rows and meet all of them, block by slice; only the
few best of each meeting go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickguard.operators.attach import attach
from tickguard.session import settle

ANCHOR_BLOCK = 2048        # anchors of one tree, on average
SLICE = 8192               # candidates that meet a block at once, on average
STEP = 1024                # candidates that walk the tree together
EXACT = float(1 << 53)     # whole numbers below are exact in doubles
LONGEST = (1 << 63) - 1

ANCHOR = "id long, label long, vec array<bigint>, row long"
TREE = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()),
                  ("vec", pa.list_(pa.int64())), ("place", pa.int32()), ("parent", pa.int32()),
                  ("edge", pa.float64())])
FOUND = pa.schema([("row", pa.int64()), ("anchor", pa.int64()), ("positive", pa.int64()),
                   ("p_score", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def prepare(rows: DataFrame, scale: int = 256, relabel_every: int = 7, classes: int = 10) -> DataFrame:
    """``rows`` (vec_id, embedding, label) that take part, as (id, label, vec): components floor(scale * x)."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    label = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label").cast("long") + 1) % classes)
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .filter(F.coalesce(sound, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("id"),
                    F.coalesce(label, F.col("label").cast("long")).alias("label"),
                    F.transform(x, lambda v: F.floor(v * float(scale))).cast("array<bigint>").alias("vec")))


def _matrix(vecs: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros. Whole numbers too large for doubles stay Python's."""
    vecs = vecs.combine_chunks() if isinstance(vecs, pa.ChunkedArray) else vecs
    sizes = vecs.value_lengths().to_numpy(zero_copy_only=False)
    flat = vecs.flatten().to_numpy(zero_copy_only=False)
    width = max([width, *sizes.tolist()])
    if len(sizes) and (sizes == width).all():
        whole = flat.reshape(len(sizes), width)
    else:
        whole = np.zeros((len(sizes), width), np.int64)
        whole[np.arange(width) < sizes[:, None]] = flat
    large = len(flat) and float(np.abs(flat.astype(np.float64)).max()) ** 2 * width >= EXACT
    return whole.astype(object) if large else whole.astype(np.float64)


def _norms(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return np.sqrt((rows * rows).sum(axis=1))


def spanning_tree(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's tree over ``rows``: order of joining, and per joined row its parent's place and edge length."""
    rows = rows.astype(np.float64)
    n = len(rows)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    squares = (rows * rows).sum(axis=1)
    far, by, place = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
    left = np.ones(n, bool)
    at = int(np.argmin(squares))
    for k in range(n):
        order[k], place[at], left[at] = at, k, False
        if k:
            parent[k] = place[by[at]]
            edge[k] = np.sqrt(((rows[at] - rows[by[at]]) ** 2).sum())
        gap = squares + squares[at] - 2 * (rows @ rows[at])
        closer = left & (gap < far)
        far[closer], by[closer] = gap[closer], at
        if k + 1 < n:
            at = int(np.argmin(np.where(left, far, np.inf)))
            if not left[at]:             # distances beyond doubles: any row left will do
                at = int(np.argmax(left))
    return order, parent, edge


def _planted(key: tuple[pa.Scalar, ...], anchors: pa.Table) -> pa.Table:
    """The anchors of a block in tree order."""
    order, parent, edge = spanning_tree(_matrix(anchors["vec"]))
    n = len(order)
    sorted_ = anchors.take(pa.array(order))
    return pa.table([pa.array([key[0].as_py()] * n, pa.int64()), sorted_["row"], sorted_["id"], sorted_["label"],
                     sorted_["vec"], pa.array(np.arange(n), pa.int32()), pa.array(parent, pa.int32()),
                     pa.array(edge, pa.float64())], schema=TREE)


class Walk:
    """A tree of anchors, as candidates walk it level by level."""

    def __init__(self, anchors: pa.Table, width: int):
        self.vecs = _matrix(anchors["vec"], width)
        self.parent = anchors["parent"].to_numpy()
        self.edge = anchors["edge"].to_numpy()
        depth = np.zeros(len(self.parent), np.int64)
        for k in range(1, len(depth)):
            depth[k] = depth[self.parent[k]] + 1
        self.levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=-1)) + 1)]

    def scores(self, cands: np.ndarray, low: np.ndarray, high: np.ndarray,
               apart: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, candidates, exact scores) of all pairs whose score may lie in [low, high] of the anchor.

        ``apart``, if given, marks pairs (anchor, candidate) that need no score.
        """
        norms = _norms(cands)
        floor_, ceil_ = np.empty((2, len(self.parent), len(cands)))
        plain = self.vecs.dtype == np.float64 and cands.dtype == np.float64
        if plain and len(cands) and len(self.vecs):
            plain = _norms(self.vecs).max() * norms.max() < EXACT
        left, right = (self.vecs, cands) if plain else (self.vecs.astype(object), cands.astype(object))
        if not plain:                    # whole numbers of any size
            left, right = (np.vectorize(int, otypes=[object])(m) if m.size else m for m in (left, right))
        for level, nodes in enumerate(self.levels):
            if level:
                reach = self.edge[nodes][:, None] * norms[None, :] * (1 + 1e-9) + 1
                floor_[nodes] = floor_[self.parent[nodes]] - reach
                ceil_[nodes] = ceil_[self.parent[nodes]] + reach
                may = ~((ceil_[nodes] < low[nodes, None]) | (floor_[nodes] > high[nodes, None]))
            else:
                may = np.ones((len(nodes), len(cands)), bool)
            if apart is not None and level:
                may &= ~apart[nodes]
            if not may.any():
                continue
            if plain and may.mean() < 0.1:
                a, c = np.nonzero(may)
                exact = np.zeros(may.shape)
                exact[a, c] = np.einsum("ij,ij->i", left[nodes[a]], right[c])
            else:
                exact = left[nodes] @ right.T
            sure = exact.astype(np.float64)
            slack = 0 if plain else np.abs(sure) * 1e-9
            floor_[nodes] = np.where(may, sure - slack, floor_[nodes] if level else 0)
            ceil_[nodes] = np.where(may, sure + slack, ceil_[nodes] if level else 0)
            if apart is not None and not level:
                may &= ~apart[nodes]
            exact = exact.astype(np.int64) if plain else np.clip(exact, -LONGEST, LONGEST)
            for k, node in enumerate(nodes.tolist()):
                picked = np.flatnonzero(may[k])
                if len(picked):
                    yield node, picked, exact[k, picked]


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` by falling score and rising id; equal pairs count once."""
    if len(ids) > 4 * n and scores.dtype != object:
        keep = scores >= np.partition(scores, len(scores) - n)[len(scores) - n]
        some = set(zip(scores[keep].tolist(), ids[keep].tolist(), strict=True)) if keep.sum() <= 4 * n else ()
        if len(some) >= n:               # else repeated pairs would take the places of others
            ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores)) if scores.dtype != object else np.array(
        sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), np.int64)
    ids, scores = ids[order], scores[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
    return ids[new][:n], scores[new][:n]


class _Lists:
    """The best candidates so far, per anchor and window."""

    def __init__(self, n: int):
        self.n, self.lists = n, {}

    def add(self, key: tuple[int, int], ids: np.ndarray, scores: np.ndarray) -> None:
        if key in self.lists:
            ids, scores = (np.concatenate(both) for both in zip(self.lists[key], (ids, scores), strict=True))
        self.lists[key] = _best(ids, scores, self.n)

    def last(self, key: tuple[int, int]) -> float:
        """The least score that could still enter."""
        ids, scores = self.lists.get(key, ((), ()))
        return float(scores[-1]) if len(ids) == self.n else -np.inf


def _positives(n: int):
    def meet(_, anchors: pa.Table, cands: pa.Table) -> pa.Table:
        if not len(anchors) or not len(cands):
            return FOUND.empty_table()
        anchors = anchors.sort_by("place")
        walk, best = None, _Lists(n)
        own = anchors["id"].to_numpy()
        for at in range(0, len(cands), STEP):
            some = cands.slice(at, STEP)
            ids, vecs = some["id"].to_numpy(), _matrix(some["vec"])
            width = max(vecs.shape[1], _matrix(anchors["vec"]).shape[1]) if walk is None else walk.vecs.shape[1]
            if walk is None or vecs.shape[1] > width:
                walk = Walk(anchors, max(width, vecs.shape[1]))
            vecs = _matrix(some["vec"], walk.vecs.shape[1])
            low = np.array([best.last((k, 0)) for k in range(len(own))])
            for k, picked, scores in walk.scores(vecs, low, np.full(len(own), np.inf), own[:, None] == ids[None, :]):
                best.add((k, 0), ids[picked], scores)
        return _told(anchors, best, None)

    return meet


def _negatives(n: int, percent: int):
    def meet(_, anchors: pa.Table, cands: pa.Table) -> pa.Table:
        if not len(anchors) or not len(cands):
            return FOUND.empty_table()
        anchors = anchors.sort_by("place")
        windows = anchors["windows"].to_pylist()
        walk, best = None, _Lists(n)
        labels = anchors["label"].to_numpy()
        for at in range(0, len(cands), STEP):
            some = cands.slice(at, STEP)
            ids, vecs = some["id"].to_numpy(), _matrix(some["vec"])
            width = max(vecs.shape[1], _matrix(anchors["vec"]).shape[1]) if walk is None else walk.vecs.shape[1]
            if walk is None or vecs.shape[1] > width:
                walk = Walk(anchors, max(width, vecs.shape[1]))
            vecs = _matrix(some["vec"], walk.vecs.shape[1])
            low, high = np.full(len(labels), np.inf), np.full(len(labels), -np.inf)
            for k, one in enumerate(windows):
                for j, w in enumerate(one or []):
                    if w["score"] >= 0:          # below zero the window is empty
                        low[k] = min(low[k], max(w["score"] * percent / 100 * (1 - 1e-9) - 1, best.last((k, j))))
                        high[k] = max(high[k], w["score"] * (1 + 1e-9))
            same = labels[:, None] == some["label"].to_numpy()[None, :]
            for k, picked, scores in walk.scores(vecs, low, high, same):
                for j, w in enumerate(windows[k] or []):
                    inside = (scores * 100 >= w["score"] * percent) & (scores <= w["score"])
                    if inside.any():
                        best.add((k, j), ids[picked[inside]], scores[inside])
        return _told(anchors, best, windows)

    return meet


def _told(anchors: pa.Table, best: _Lists, windows: list | None) -> pa.Table:
    rows, own = anchors["row"].to_pylist(), anchors["id"].to_pylist()
    out = {name: [] for name in FOUND.names}
    for (k, j), (ids, scores) in best.lists.items():
        w = windows[k][j] if windows else {"id": None, "score": None}
        for i, s in zip(ids.tolist(), scores.tolist(), strict=True):
            for name, value in zip(FOUND.names, (rows[k], own[k], w["id"], w["score"], i, s), strict=True):
                out[name].append(value)
    return pa.table({f.name: pa.array(out[f.name], f.type) for f in FOUND}, schema=FOUND)


def _first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    """``found`` with ``rank`` up to ``n``; equal rows count once."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _parts(count: int | Column, size: int) -> int | Column:
    return max(1, -(-count // size)) if isinstance(count, int) else F.greatest(
        F.lit(1), F.ceil(count / size)).cast("long")


def mine(rows: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 5,
         percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows``
    (vec_id, embedding, label).

    Rows without an id, label or vector, or with a null, infinite or NaN component, take no
    part. Anchors are the rows whose id ``anchor_every`` divides. A score is the integer inner
    product of components floor(256 * x); higher is better, ties go to the smaller id. The
    positives of an anchor are its first rows of the same label and another id, the negatives
    of a positive the first rows of other labels that score between ``percent`` per cent of
    the positive and the positive itself; below a score of zero there are none.

    Rows that agree in id, label and vector count once. Vectors may differ in length: the
    shorter one ends in zeros; an empty one scores zero. Components saturate at 64 bits; scores are computed
    exactly whatever the size, then saturate likewise. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    cands = settle(prepare(rows), "vectors")
    picked = cands.filter(F.col("id") % anchor_every == 0).distinct()
    anchors = settle(picked.withColumn("row", F.monotonically_increasing_id()), "anchors")
    n, a = cands.count(), anchors.count()

    def trees(blocked: DataFrame) -> DataFrame:
        return settle(blocked.select("block", "row", "id", "label", "vec").groupBy("block").applyInArrow(
            _planted, "block long, row long, id long, label long, vec array<bigint>, place int, parent int, "
                      "edge double"), "trees")

    # Positives: a label's anchors, in blocks, meet the label's rows, in slices.
    own = anchors.groupBy("label").agg(F.count(F.lit(1)).alias("anchors"))
    sizes = (cands.join(F.broadcast(own) if a <= 100_000 else own, "label").groupBy("label")
             .agg(F.count(F.lit(1)).alias("weight"), F.first("anchors").alias("anchors")))
    sizes = settle(sizes.select("label", "weight", _parts(F.col("anchors"), ANCHOR_BLOCK).alias("blocks"),
                                _parts(F.col("weight"), SLICE).alias("slices")), "sizes")
    part = F.pmod(F.xxhash64("id"), F.col("blocks"))
    sized = attach(anchors, sizes, ["label"], "weight", deal_by=["row"])
    grown = trees(sized.withColumn("block", F.xxhash64("label", part)))
    sized = sized.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    left = grown.join(sized, "row")
    right = attach(cands, sizes, ["label"], "weight", deal_by=["id", "vec"]).withColumns({
        "slice": F.pmod(F.xxhash64("id", "vec"), F.col("slices")),
        "part": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))})
    right = right.select(F.xxhash64("label", "part").alias("block"), "slice", "id", "label", "vec")
    schema = "row long, anchor long, positive long, p_score long, id long, score long"
    met = (left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice"))
           .applyInArrow(_positives(positives), schema))
    best = settle(_first(met.select("row", "anchor", "id", "score").distinct(), ["row"], positives), "positives")

    # Negatives: all anchors that have positives, in blocks, meet all rows, in slices.
    opened = best.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("id", "score"))).alias("windows"))
    blocks, slices = _parts(a, ANCHOR_BLOCK), _parts(n, SLICE)
    grown = trees(anchors.join(best.select("row").distinct(), "row")
                  .withColumn("block", F.pmod(F.xxhash64("id", "row"), F.lit(blocks))))
    left = (grown.join(opened, "row")
            .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))))
    right = cands.withColumns({
        "slice": F.pmod(F.xxhash64("id", "vec"), F.lit(slices)),
        "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))})
    met = (left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice"))
           .applyInArrow(_negatives(negatives, percent), schema))
    ranked = _first(met.distinct(), ["row", "positive", "p_score"], negatives)
    return ranked.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), F.col("p_score").alias("positive_score"),
        F.col("score").alias("negative_score"))
