"""Operators whose result SQL does not express, against plain Python on small inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tickguard.llm import decontam, lm, packing, pii, quality, sharding, simhash, substring, toxicity
from tickguard.llm.queries import QUERIES, word_bpe

WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


# --- personal data -------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, s):
    digits = [int(c) for c in s if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items()
            for m in re.finditer(p, text or "") if passes(k, m.group())]


def test_pii_base_on_hard_strings(spark):
    rnd = random.Random(3)
    hard = ["".join(rnd.choice("0123456789.@+-( )ab\né") for _ in range(rnd.randrange(120))) for _ in range(400)]
    hard += ["a@b.c.d@e.f_x@y.z", "1.2.3.4.5.6.7.8", "001.0255.3.4 256.1.1.1", "4111 1111-1111 1111 4111111111111111",
             "+1 (555) 010-2030-", "é+49 30 1234567", "1" * 3000, "a." * 3000 + "@", "x@" + "b." * 3000 + "c",
             "4111-1111-1111-1111-1", "+123456789012345 6", "0" * 12 + " 0"]
    df = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")
    from pyspark.sql import functions as F

    got = {r.doc_id: [(pii.KINDS[s.kind], s.a, s.b) for s in r.spans]
           for r in df.select("doc_id", pii.base_spans(F.col("text")).alias("spans")).collect()}
    for i, text in enumerate(hard):
        assert got[i] == base(text), text[:80]


def test_pii_trees_and_thresholds_come_from_all_candidates(spark):
    # The first 30,000 candidates by turn are all wrong; of the others, the odd ones are right.
    wrong = "id < 30000 or id % 2 = 0"
    rows = spark.range(60_000).selectExpr(
        "cast(id % 4 as int) AS kind", "cast(0 as int) AS a", "cast(9 as int) AS b", "id AS turn",
        f"array(0D, if({wrong}, 1D, 2D), {', '.join(['0D'] * 14)}) AS f", f"cast(if({wrong}, 0, 1) as int) AS label")
    made = pii.Selector(rows)
    scores = rows.select("kind", "label", "turn", made.score(pii.F.col("f")).alias("score")).collect()
    held = [r for r in scores if r.turn % 3 == 0]
    want = {}
    for kind in range(4):
        for cut in sorted({r.score for r in held if r.kind == kind}):
            passed = [r.label for r in held if r.kind == kind and r.score >= cut]
            if sum(passed) >= pii.PRECISION * len(passed):
                want.setdefault(kind, cut)
    assert set(want) == {1, 3} and made.cuts == want
    assert {r.label for r in scores if r.score >= made.cuts.get(r.kind, 2)} == {1}


def test_pii_query(spark, sf, texts):
    for r in QUERIES["op1_pii"](spark, sf).collect():
        want = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        counts = Counter(k for k, _, _ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in PATTERNS)
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_trees_add_what_stands_where_numbers_stand(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(400):
        card = [rnd.randrange(10) for _ in range(15)]
        s = sum(d if j % 2 else (2 * d - 9 if d > 4 else 2 * d) for j, d in enumerate(card))
        card.append((10 - s % 10 + (i % 40 == 0)) % 10)        # one in forty has a typing error
        rows.append((i, f"pay by card {''.join(map(str, card))}, order {rnd.randrange(10 ** 12, 10 ** 13)}x"))
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = sum(len(r._spans) - len(r._base) for r in found)
    assert 1 <= added <= 20
    for r in found:
        assert {tuple(s) for s in r._base} <= {tuple(s) for s in r._spans}
        places = sorted((s.a, s.b) for s in r._spans)
        assert all(x[1] <= y[0] for x, y in zip(places, places[1:], strict=False))


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é a@b.cd, 1.2.3.4!"), (2, "none"), (3, None)], "doc_id long, text string")
    made = pii.find(df).withColumn("text", pii.redacted(pii.F.col("text"), "_spans")).orderBy("doc_id")
    assert [r.text for r in made.collect()] == ["é [EMAIL], [IP]!", "none", None]


# --- toxicity ------------------------------------------------------------------

def test_toxicity_learns_from_its_folds_only(spark):
    rnd = random.Random(2)
    plain, bad = [f"w{i}" for i in range(300)], ["vilewort", "grimling", "muckface"]
    plain = ["".join(rnd.choice("abcdeiou") for _ in range(6)) for _ in range(300)]
    rows, marks = [], []
    for i in range(900):
        words = rnd.choices(plain, k=rnd.randrange(5, 60))
        if i % 5 == 0:
            words[rnd.randrange(len(words))] = rnd.choice(bad) + rnd.choice(["", "!", "s"])
        rows.append((i, " ".join(words)))
        held = zlib.crc32(str(i).encode()) % 5 == 0
        marks.append((i, rnd.randrange(2) if held else int(i % 5 == 0)))    # held-out labels are noise
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert all(0 <= r._score <= 1 and r._predicted == (r._score >= 0.5) for r in got)
    assert all(r._held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r._predicted == (r.doc_id % 5 == 0) for r in got if r._held_out]
    assert sum(right) > 0.95 * len(right)


def test_toxicity_with_one_label_or_none(spark):
    docs = spark.createDataFrame([(i, "some words") for i in range(20)], "doc_id long, text string")
    for label in (0, 1):
        labels = spark.createDataFrame([(i, label) for i in range(20)], "doc_id long, toxic int")
        assert {r._score for r in toxicity.scored(docs, labels).collect()} == {float(label)}
    assert {r._score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}


# --- repeated strings ----------------------------------------------------------

def brute_repeats(texts, length):
    seen = Counter()
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        seen.update(b[p:p + length] for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        mask = np.zeros(len(b) + 1, np.int8)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                mask[p:p + length] = 1
        kept = bytes(c for c, m in zip(b, mask, strict=False) if not m)
        out.append((len(b), int(mask.sum()), int((np.diff(np.r_[0, mask]) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("alphabet,seed", [("ab", 1), ("abcdefgh ", 2), ("é東a", 3)])
def test_repeats_of_short_strings(spark, alphabet, seed):
    rnd = random.Random(seed)
    shared = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(20, 90))) for _ in range(4)]
    texts = [None, "", "a" * 39, "a" * 40, "a" * 41, "ab" * 50]
    for _ in range(60):
        own = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(3)]
        texts.append("".join(x for o in own for x in (o, rnd.choice([*shared, ""]))))
    texts += [texts[9], texts[9]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:5] for r in substring.repeats(df, 40, 10).collect()}
    for i, want in enumerate(brute_repeats(texts, 40)):
        assert got[i] == want, (i, texts[i])


def test_cells_of_windows_leave_few_to_compare_alone(spark, monkeypatch):
    rnd = random.Random(11)

    def noise(n):
        return "".join(rnd.choice("abcdefgh") for _ in range(n))

    base, texts = noise(3000), []
    for i in range(12):                      # copies that differ in a few places, so runs differ and windows meet
        copy = list(base)
        for at in range(200 + 7 * i, 3000, 900):
            copy[at] = "#"
        texts.append("".join(copy) + noise(5 * i))
    texts += [noise(300) + base[1000:1400 + i] + noise(300) for i in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, settled = Counter(), substring.settle

    def counted(table, label="table"):
        made = settled(table, label)
        rows[label] += made.count()
        return made

    monkeypatch.setattr(substring, "settle", counted)
    got = {r.doc_id: tuple(r)[1:5] for r in substring.repeats(df).collect()}
    for i, want in enumerate(brute_repeats(texts, 400)):
        assert got[i] == want
    windows = sum(n for t in texts for _, _, n, *_ in substring.named_suffixes([t.encode()], 400, 64))
    assert max(rows.values()) < windows / 3, (rows, windows)


def test_chunks_lose_no_window(monkeypatch):
    monkeypatch.setattr(substring, "CHUNK", 97)
    rnd = random.Random(5)
    texts = [bytes(rnd.choice(b"abc") for _ in range(n)) for n in (0, 39, 40, 41, 97, 400, 1000)]
    seen = Counter()
    for i, start, windows, *_ in substring.named_suffixes(texts, 40, 8):
        seen.update((i, p) for p in range(start, start + windows))
    assert seen == Counter((i, p) for i, t in enumerate(texts) for p in range(len(t) - 39))


def test_levels_stay_logarithmic(spark):
    index = substring.SuffixIndex(spark)
    for b in range(5):
        rows = spark.createDataFrame([(1, b), (2, 7), (b, b)], "head long, around long")
        met = {tuple(r) for r in index.add(rows).collect()}
        assert ((2, 7) in met) == (b > 0)
    assert [n for n, _ in index.levels] == [4, 1]


# --- quality -------------------------------------------------------------------

def test_quality_counts(spark, sf, texts):
    for r in QUERIES["op4_quality_rules"](spark, sf).collect():
        text = texts[r.doc_id] or ""
        words = re.findall(WORD, text)
        lines = [line for line in text.split("\n") if re.search(WORD, line)]
        windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
        assert tuple(r)[1:6] == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                                 len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(words) < 10 or 100 * len(hit) > 20 * len(words))
        assert not (r.base_failed and r.kept)


def test_sketches_merge_and_bound_the_quantiles(spark):
    rnd = random.Random(4)
    values = [int(rnd.lognormvariate(5, 2)) for _ in range(3000)]
    names = list(quality.METRICS)
    df = spark.createDataFrame([("x" if i % 3 else "y", *[v] * len(names)) for i, v in enumerate(values)],
                               ["g", *names])
    whole = quality.quartiles(quality.sketches(df.withColumn("g", quality.F.lit("z")), ["g"]), ["g"])
    merged = quality.sketches(df, ["g"]).groupBy("metric", "bin").agg(quality.F.sum("n").alias("n"))
    merged = quality.quartiles(merged.withColumn("g", quality.F.lit("z")), ["g"])
    assert sorted(whole.collect()) == sorted(merged.select(whole.columns).collect())
    q1, q3 = sorted(values)[(len(values) - 1) // 4], sorted(values)[(3 * len(values) - 1) // 4]
    row = whole.first()
    assert row.q1 <= q1 <= row.q1 * 33 / 32 + 1 and row.q3 <= q3 <= row.q3 * 33 / 32 + 1


# --- near copies ---------------------------------------------------------------

def grouped(prints, apart):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    arr = np.array(prints, np.uint64)
    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= apart):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(arr))]


@pytest.mark.parametrize("apart", [1, 2, 4])
def test_links_between_fingerprints(spark, apart):
    rnd = random.Random(apart)
    prints = {0, 1 << 63, (1 << 64) - 1}
    for _ in range(60):
        p = rnd.getrandbits(64)
        for _ in range(rnd.randrange(8)):
            prints.add(p)
            for b in rnd.sample(range(64), rnd.randrange(apart + 2)):
                p ^= 1 << b
    centre = rnd.getrandbits(64)
    prints |= {centre ^ sum(1 << b for b in rnd.sample(range(12), rnd.randrange(8))) for _ in range(300)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r.fp: r.root for r in simhash.link_groups(df, apart).collect()}
    want = grouped(prints, apart)
    pairs = {(got[s], w) for s, w in zip(signed, want, strict=True)}
    assert len(pairs) == len(set(got.values())) == len(set(want))


def test_simhash_query(spark, sf, texts):
    got = {r.doc_id: r for r in QUERIES["op5_simhash"](spark, sf).collect()}
    ids, prints = list(texts), []
    for i in ids:
        words = re.findall(WORD, lower(texts[i]))
        shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        ones = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s.encode(), 42)
            for b in range(64):
                ones[b] += h >> b & 1
        prints.append(sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles)))
    roots = grouped(prints, 4)
    least = {}
    for i, r in zip(ids, roots, strict=True):
        least[r] = min(least.get(r, i), i)
    for i, p, r in zip(ids, prints, roots, strict=True):
        assert (got[i].fingerprint, got[i].component_id) == (f"{p:016x}", least[r])


def test_first_of_each_group_stays(spark):
    rows = [(4, "one two three four five"), (2, "one two three four five"), (2, "one two three four five"),
            (9, "quite another text, with words"), (None, "quite another text, with words"), (None, "alone here")]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, (r.doc_id for r in kept))) == ["2", "9", "None"]


# --- packing -------------------------------------------------------------------

def brute_pack(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms[rooms.index(min(fits))] -= n
        else:
            rooms.append(size - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    size = rnd.choice([16, 64, 100, 2048])
    counts = {rnd.randrange(1, size + 1): rnd.randrange(1, 30) for _ in range(rnd.randrange(1, 25))}
    windows, pieces = {}, Counter()
    for length, first, n, window, at in packing.plan(counts, size):
        for k in range(n):
            windows.setdefault(window + k, []).append((at, length))
            pieces[length, first + k] += 1
    assert pieces == Counter((n, i) for n, c in counts.items() for i in range(c))
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    rooms = sorted(size - sum(n for _, n in held) for held in windows.values())
    assert rooms == brute_pack([n for n, c in counts.items() for _ in range(c)], size)
    assert set(windows) == set(range(len(windows)))


def test_packing_query(spark, sf, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_bpe())
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    rows = QUERIES["op6_packing"](spark, sf).collect()
    covered = Counter()
    for r in rows:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert (zlib.crc32(piece.tobytes()), len(piece), len(ids[r.doc_id])) == (r.ids_crc32, r.length, r.doc_tokens)
        covered[r.doc_id] += r.length
    assert covered == Counter({i: len(x) for i, x in ids.items()})
    used = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and sum(used.values()) > 0.97 * 2048 * (len(used) - 1)


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_bpe())
    texts = ["It's <|endoftext|> <|ENDOFTEXT|> don't  x", "ﬁne İstanbul Straße ΑΣ ς é é 12.5% 'S", "",
             "a...b c_d --- ... \u3000x\x85y 东京!? ¿qué? “q”", "A'S B'Ll  \x1c k \t\n z", "word. Word, word"]
    made = packing.Encoder.of(word_bpe())(texts)
    for text, got in zip(texts, made, strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids + [packing.END]
        assert np.frombuffer(got, "<u4").tolist() == want


# --- sharding ------------------------------------------------------------------

def check_shards(rows, shards, slack):
    sizes, slots = Counter(), {}
    for r in rows:
        sizes[r._shard] += r._size
        slots.setdefault(r._shard, []).append(r._slot)
    share = sum(sizes.values()) / shards
    assert all(abs(sizes[s] - share) <= slack for s in range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_hold_equal_bytes(documents):
    rows = sharding.shard(documents, 8).collect()
    assert all(r._size == len((r.text or "").encode()) + 1 for r in rows)
    check_shards(rows, 8, 2 * max(r._size for r in rows))
    again = {r.doc_id: r._shard for r in sharding.shard(documents.repartition(7), 8).collect()}
    assert all(again[r.doc_id] == r._shard for r in rows)


def test_a_text_of_a_third_of_all_rows_is_split(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text number {i}" + "x" * (i % 50)) for i in range(3000)]
    check_shards(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect(), 8, 200)
    same = spark.createDataFrame([(1, "all the same")] * 50, "doc_id long, text string")
    assert sharding.shard(same, 8).count() == 50


# --- decontamination -----------------------------------------------------------

def brute_hits(words, windows):
    hit, items = set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if found := windows.get(tuple(words[i:i + size])):
                hit.update(range(i, i + size))
                items |= found
    return hit, items


@pytest.mark.parametrize("seed", range(8))
def test_automaton(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(rnd.choice([2, 4, 12]))]
    items = [(str(i), " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 2, 4, 5, 9])))) for i in range(rnd.randrange(1, 9))]
    if seed % 2:
        items = [(i, t) for i, t in items if len(t.split()) != 1]
    windows = {}
    for item, text in items:
        words = text.split()
        for i in range(max(len(words) - 3, 1) if words else 0):
            windows.setdefault(tuple(words[i:i + 4]), set()).add(item)
    automaton = decontam.Automaton([(i, t.encode()) for i, t in items], 4)
    for _ in range(60):
        words = rnd.choices([*vocab, "other"], k=rnd.randrange(40))
        runs, found = automaton.hits([w.encode() for w in words])
        hit, want = brute_hits(words, windows)
        assert {k for a, b in runs for k in range(a, b)} == hit and found == want
        assert all(x[1] < y[0] for x, y in zip(runs, runs[1:], strict=False))


def test_decontamination_query(spark, sf, texts):
    cut = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = {}
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        words = re.findall(cut, lower(r.text))
        for i in range(max(len(words) - 9, 1) if words else 0):
            windows.setdefault(tuple(words[i:i + 10]), set()).add(str(r.item_id))
    for r in QUERIES["op9_decontamination"](spark, sf).collect():
        words = re.findall(cut, lower(texts[r.doc_id]))
        hit, items = brute_hits(words, windows)
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert tuple(r)[1:] == (len(words), len(hit), len(items), sha, bool(hit))


def test_blocks_of_items_and_cut_texts(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i}") for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Keep this, ALPHA3 beta3! gamma3 and that; alpha9 beta9 gamma9 end"),
                                  (2, "alpha1 beta1 gamma1 x"), (3, "clean"), (4, None)], "doc_id long, text string")
    one = {r.doc_id: r._items for r in decontam.find(docs, items).collect()}
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 50)
    many = {r.doc_id: sorted(r._items) for r in decontam.find(docs, items).collect()}
    assert many == {k: sorted(v) for k, v in one.items()} == {1: ["3", "9"], 2: ["1"], 3: [], 4: []}
    made = {r.doc_id: r.text for r in decontam.clean(docs, items, max_coverage=0.7).collect()}
    assert made == {1: "Keep this,  and that;  end", 3: "clean", 4: None}


# --- language model ------------------------------------------------------------

def test_lm_scores(spark, sf, texts, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 500)              # so that most words are looked up by the join
    rows = QUERIES["op10_lm_scoring"](spark, sf).collect()
    tokens = {i: [w.encode() for w in re.findall(WORD, lower(t))] + [b""] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total = sum(counts.values())
    assert len(rows) == len(texts)
    for r in rows:
        words = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words), total)
        assert r.n_known == sum(w in counts for w in words)
        assert r.base_score == pytest.approx(
            sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words), rel=1e-9)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_model_is_normalised_and_beats_the_unigrams():
    rng = np.random.default_rng(1)
    size = 30
    chances = rng.dirichlet(np.full(size, 0.1), size)
    pairs = np.array([(a, b) for a in range(size) for b in range(size)])
    counts = np.round(20_000 * chances.ravel()).astype(int)
    pairs, counts = pairs[counts > 0], counts[counts > 0]
    model = lm.LogBilinear(size)
    model.fit(pairs, counts)
    table = model.log10()
    assert np.allclose((10.0 ** table).sum(1), 1, atol=1e-4)
    uni = np.bincount(pairs[:, 1], counts, size)
    uni = np.log10(uni / uni.sum())
    assert (counts * table[pairs[:, 0], pairs[:, 1]]).sum() > (counts * uni[pairs[:, 1]]).sum() * 0.8
