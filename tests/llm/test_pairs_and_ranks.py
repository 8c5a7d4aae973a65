"""Hard negatives, n-gram joins and lexical search against plain Python, and their bounds."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickguard.llm import jaccard, lexical, negatives
from tickguard.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>, label int"


def mined(rows, every=100, k=5):
    """The contract, row by row: distinct (id, label, vector), exact whole numbers."""
    sound = {(i, (l + 1) % 10 if i % 7 == 0 else l, tuple(math.floor(256 * x) for x in v))
             for i, v, l in rows if i is not None and l is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in (r for r in sound if r[0] % every == 0):
        dot = {r: sum(x * y for x, y in zip(a[2], r[2])) for r in sound if r[0] != a[0]}
        same = sorted({(-s, r[0]) for r, s in dot.items() if r[1] == a[1]})[:k]
        for s, positive in same:
            s = -s
            others = sorted({(-n, r[0]) for r, n in dot.items() if r[1] != a[1] and 80 * s <= 100 * n <= 100 * s})
            out += [(a[0], positive, rank, i, s, -n) for rank, (n, i) in enumerate(others[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_hard_negatives_equal_brute_force(spark, spread, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 8))
    rows = [(int(i), (centres[i % 5] + spread * rng.normal(size=8)).round(3).tolist(), int(rng.integers(3)))
            for i in range(400)]
    rows += rows[:3] + [(7, [1.0] * 8, 1), (8, None, 1), (None, [1.0] * 8, 1), (9, [1.0] * 8, None),
                        (300, [float("nan")] * 8, 1), (301, [None] * 8, 1), (302, [float("inf")] * 8, 1),
                        (303, [2.0, 1.0], 1), (304, [], 0)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS score", "1 AS row", "2 AS id")
    for block, size in ((negatives.ANCHOR_BLOCK, negatives.SLICE), (2, 50)):
        monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block)
        monkeypatch.setattr(negatives, "SLICE", size)
        assert sorted(tuple(r) for r in negatives.mine(df, anchor_every=20).collect()) == mined(rows, 20)
    assert negatives.mine(df.limit(0)).count() == 0


def test_large_components_are_exact_and_the_largest_saturate(spark):
    rng = random.Random(2)
    rows = [(i, [1e6 + rng.randrange(9) / 256, 1e6 + rng.randrange(9) / 256], 1 + i % 2) for i in range(60)]
    made = negatives.mine(spark.createDataFrame(rows, VECTORS), anchor_every=20)
    want = mined(rows, 20)
    assert min(r[-1] for r in want) > 1 << 53
    assert sorted(tuple(r) for r in made.collect()) == want
    vast = negatives.mine(spark.createDataFrame([(i, [3e9], 1 + i % 2) for i in range(1, 101)], VECTORS))
    assert {tuple(r) for r in vast.select("positive_score", "negative_score").collect()} == {((1 << 63) - 1,) * 2}


def test_bounds_hold_and_leave_far_candidates_unscored():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    near = (1000 * rng.normal(size=16) + rng.normal(size=(40, 16)) * 5).round().astype(np.int64)
    order, parent, edge = negatives.spanning_tree(near.astype(float))
    assert sorted(order.tolist()) == list(range(40)) and parent[0] == -1 and (parent[1:] < np.arange(1, 40)).all()
    anchors = pa.table({"vec": pa.array(near[order].tolist(), pa.list_(pa.int64())), "parent": parent, "edge": edge})
    cands = (1000 * rng.normal(size=(500, 16))).round()
    exact = near[order] @ cands.T
    low = np.sort(exact, axis=1)[:, -10]
    seen = {}
    for node, picked, scores in negatives.Walk(anchors, 16).scores(cands, low.astype(float), np.full(40, np.inf), None):
        assert (scores == exact[node, picked]).all()
        seen[node] = set(picked.tolist())
    for node in range(40):
        assert set(np.flatnonzero(exact[node] >= low[node]).tolist()) <= seen.get(node, set())
    assert sum(map(len, seen.values())) < 0.2 * exact.size


def shingled(text, size=5):
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def grouped(rows):
    sets = [(i, shingled(t)) for i, t in rows]
    root = list(range(len(sets)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k, (i, _) in enumerate(sets):
        least.setdefault(top(k), []).append(i)
    return sorted((i, len(s), min(least[top(k)])) for k, (i, s) in enumerate(sets))


def test_jaccard_query_equals_brute_force(spark, sf, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op12_ngram_jaccard"](spark, sf).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == grouped(rows)


def test_crowds_chains_and_short_texts_lose_no_link(spark):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(40)]
    rows = []
    for size in (3, 5, 6, 7, 9, 12, 17, 30, 80, 200, 400):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(12):
            base = list(base)                     # each copy is made from the one before: a chain
            for _ in range(rng.randrange(1 + size // 25)):
                base[rng.randrange(size)] = rng.choice(words)
            if rng.random() < 0.4:
                base = base[rng.randrange(2):] + [rng.choice(words)] * rng.randrange(2)
            rows.append((len(rows), " ".join(base)))
    frame = " ".join(rng.choice(words) for _ in range(150))
    rows += [(len(rows) + k, f"{frame} {' '.join(rng.choice(words) for _ in range(rng.choice((30, 36, 44))))}")
             for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard.similar_groups(docs)
    assert sorted(tuple(r) for r in got.collect()) == grouped(rows)


def test_sets_are_made_once_for_all_rounds(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    frames = [" ".join(rng.choice(words) for _ in range(150)) for _ in range(2)]
    texts = [f"{frames[k % 2]} {' '.join(rng.choice(words) for _ in range(rng.choice((17, 19, 21, 23))))}"
             for k in range(300)]
    rows = list(enumerate(texts))
    read, settle = Counter(), jaccard.settle

    def counted(table, label="table"):
        read[label] += 1
        return settle(table, label)

    monkeypatch.setattr(jaccard, "settle", counted)
    monkeypatch.setattr(jaccard, "CELL", 32)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in jaccard.similar_groups(docs).collect())
    assert got == grouped(rows)
    assert read["sets"] == 1 and read["links"] > 1, read


def test_a_crowd_just_below_the_threshold_is_not_paired(spark, monkeypatch):
    rng = random.Random(6)
    frame = [f"f{k}" for k in range(150)]
    rows = [(k, " ".join(frame + [f"d{k}w{i}" for i in range(22)])) for k in range(200)]
    rows += [(200 + k, f"{text} {rng.choice(frame)}") for k, text in rows[:20]]      # these are linked
    paired, settle = [], jaccard.settle

    def counted(table, label="table"):
        made = settle(table, label)
        if label == "pairs":
            paired.append(made.count())
        return made

    monkeypatch.setattr(jaccard, "settle", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in jaccard.similar_groups(docs).collect()) == grouped(rows)
    assert sum(paired) < 3 * len(rows), paired


def test_parity_words_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(3)
    for size in (1, 5, 60, 900, 9000):
        x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for share in (0.0, 0.1, 0.5):
            own = int(size * share)
            y = np.concatenate((x[own:], rng.integers(0, 1 << 63, own, dtype=np.uint64)))
            apart = (jaccard._parity(x) ^ jaccard._parity(y)).view(np.uint64)
            bits = sum(int(part).bit_count() for part in apart)
            assert len(apart) == jaccard.PARITY and bits <= len(np.setxor1d(x, y))
            assert bits > 0 or not own


def test_the_sketch_counts_repeated_entries_only():
    def sketch(texts):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
        *_, last = jaccard._prints(pa.int64(), 5, 80, 0)(iter([batch]))
        counts = last.column("counts")[0].as_py()
        return 0 if counts is None else sum(counts)

    words = [f"u{k}" for k in range(4000)]
    alone = [" ".join(words[k:k + 100]) for k in range(0, 4000, 100)]
    few = sketch(alone)                                  # empty segments
    assert few < 2 * len(alone) * jaccard.Scheme().segments(jaccard.Scheme().band(96))[0] / 4
    assert sketch([*alone, alone[0]]) == few             # copies are one class
    assert sketch([*alone, alone[0] + " more"]) > few


def test_any_similar_sets_meet_in_what_is_allotted():
    rng = np.random.default_rng(2)
    scheme = jaccard.Scheme()
    for size in (5, 6, 9, 13, 30, 100, 300):
        for _ in range(30):
            y = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            x = y.copy()
            while True:                           # take and put shingles while the sets stay similar
                z = np.delete(x, rng.integers(len(x))) if rng.random() < 0.6 and len(x) > 1 else np.unique(
                    np.append(x, rng.integers(0, 1 << 63, dtype=np.uint64)))
                common = len(np.intersect1d(y, z))
                if len(z) > len(y) or 100 * common < 80 * (len(y) + len(z) - common):
                    break
                x = z
            band = scheme.band(len(x))
            assert band in scheme.bands(len(y))
            (wx, _, lx, ox), (wy, sizes, ly, oy) = (scheme.keys(s, *jaccard._sums(s), band) for s in (x, y))
            need = scheme.apart(len(y), min(len(y), scheme.edges[band + 1] - 1)) + 1
            one = rng.random(len(wy)) * 100
            given = jaccard.allot(one, rng.random(scheme.segments(band)[1]) * 100, need, 20)
            assert given.sum() >= need
            met = 0
            for i, a in enumerate(given.tolist()):
                same = wx[i] == wy[i]
                less = a == 2 and (wy[i] in lx[ox == i] or wx[i] in ly[oy == i])
                met += a * bool(same or less)
            assert met >= given.sum() - scheme.apart(len(x), len(y)) > 0


def ranked(docs, items, top=50):
    words = lambda t: (t or "").encode().translate(lexical._SPACE).split()
    docs = [(i, Counter(words(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(words(text)) if c[t])
            if s > 0:
                scores.append((-s, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


def test_lexical_search_equals_brute_force_in_segments_and_blocks(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"T{k}é" if k % 9 == 0 else f"t{k}" for k in range(300)]
    weights = [1 / (k + 1) for k in range(300)]

    def text(n):
        return rng.choice([" ", ", ", "-"]).join(rng.choices(words, weights, k=n))

    docs = [(i, text(rng.choice((0, 1, 5, 40, 200)))) for i in range(700)]
    docs += [(700 + i, docs[5][1]) for i in range(60)]                     # ties beyond the top
    items = [(k, text(rng.choice((1, 4, 30, 90)))) for k in range(12)] + [(99, "nowhere"), (98, "")]
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = ranked(docs, items)
    assert sorted(tuple(r) for r in lexical.rank(a, b).collect()) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 60)
    assert sorted(tuple(r) for r in lexical.rank(a, b).collect()) == want


def test_masks_are_left_out_once_they_cannot_enter():
    rng = np.random.default_rng(1)
    n, terms = 2000, 12
    sizes = rng.integers(1, terms + 1, n)
    held = np.concatenate([rng.choice(terms, s, replace=False) for s in sizes])
    segment = lexical.Segment(np.full(n, 50), sizes, held, rng.integers(1, 5, len(held)),
                              {"N": n, "L": 50 * n, "weights": np.arange(terms) ** 3 * 10})
    scored = []
    score = segment.score
    segment.score = lambda t, d: scored.append(len(d)) or score(t, d)
    docs, found = segment.best(list(range(terms)), 10, 0)
    every = score(list(range(terms)), np.arange(n))
    assert sorted(found)[-10:] == sorted(every)[-10:] and sum(scored) < n / 2
