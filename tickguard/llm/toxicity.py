"""Toxicity: boosted trees over dense features of the text, with isotonic calibration.

The lexicon is learned: words, and beginnings of words, that toxic training texts
have far more often than others. The trees see each half of the sample through the
lexicon of the other half, so that terms a text brought in itself do not count;
scoring uses the lexicon of both. A quarter of the sample only calibrates.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickguard.llm import boosting
from tickguard.llm.common import fold
from tickguard.session import settle

SAMPLE = 20_000           # labelled documents that the model learns from at most
LEXICON = 5_000           # terms at most
MIN_DOCS, MIN_ODDS = 4, 2.5
STEMS = (4, 5, 6)         # letters of a beginning
NEAR = 5                  # words between a term and a second person
CACHE = 1 << 17

#: Forms of the second person in English, German, French and Spanish.
SECOND_PERSON = set("you your yours u ur du dich dir dein deine ihr euch tu te toi ton ta "
                    "vous votre tú ti usted su ustedes vosotros".split())
_LEET = str.maketrans("013457@$!", "oieastasi")
FEATURES = ["word_hits", "stem_hits", "hit_share", "strong_hits", "near_person", "masked_hits",
            "caps", "shouted", "punctuation", "exclamations", "obfuscated", "log_words"]


def plain(word: str) -> str:
    """Letters only, in lower case, with look-alikes read as letters."""
    word = word.lower()
    if word.isalpha():
        return word
    word = word.strip(".,;:!?\"'()[]|*#%&$-")
    return word if word.isalpha() else re.sub(r"[\W\d_]+", "", word.translate(_LEET))


def terms_of(texts: pa.Array) -> pa.Array:
    """The distinct words and beginnings of each text."""
    out = []
    for text in texts.to_pylist():
        found = set()
        for w in set((text or "").split()):
            if (p := plain(w)):
                found.add(p)
                found.update(f"{p[:n]}*" for n in STEMS if len(p) > n)
        out.append(list(found))
    return pa.array(out, pa.list_(pa.string()))


def learn_lexicons(labelled: DataFrame) -> list[dict[str, float]]:
    """Terms by log odds, from rows with half 1, with half 0, and from all.

    ``labelled`` has text, label and half. One aggregate counts the texts that
    have a term; the lexicons are cut from it.
    """
    sizes = {(r.half, r.label): r["count"] for r in labelled.groupBy("half", "label").count().collect()}
    counted = [F.count_if((F.col("half") == h) & (F.col("label") == y)).alias(f"n{h}{y}")
               for h in (0, 1) for y in (0, 1)]
    terms = settle(
        labelled.select("half", "label", F.explode(F.arrow_udf(terms_of, "array<string>")("text")).alias("term"))
        .groupBy("term").agg(*counted).filter(F.col("n01") + F.col("n11") >= MIN_DOCS), "terms")
    made = []
    for halves in ([1], [0], [0, 1]):
        toxic, other = (sum(sizes.get((h, y), 0) for h in halves) for y in (1, 0))
        t, o = (sum((F.col(f"n{h}{y}") for h in halves), F.lit(0)) for y in (1, 0))
        odds = F.log((t + 0.5) / (toxic + 1)) - F.log((o + 0.5) / (other + 1))
        rows = (terms.select("term", t.alias("t"), odds.alias("odds"))
                .filter((F.col("t") >= MIN_DOCS) & (F.col("odds") >= MIN_ODDS))
                .orderBy(F.desc(F.col("odds") * F.col("t")), "term").limit(LEXICON).collect())
        made.append({r.term: r.odds for r in rows} if toxic and other else {})
    return made


def features_of(text: str, lexicon: dict[str, float], known: dict[str, tuple]) -> list[float]:
    words = text.split()
    n = max(len(words), 1)
    weights, persons, full, stems, masked, odd, shouted = [], [], 0, 0, 0, 0, 0
    for i, w in enumerate(words):
        kind = known.get(w)
        if kind is None:
            if len(known) > CACHE:
                known.clear()
            kind = known[w] = _kind(w, lexicon)
        if kind is _NOTHING:
            continue
        weight, by, hidden, person, weird, loud = kind
        if by:
            weights.append((i, weight))
            full += by == 1
            stems += by == 2
            masked += hidden
        if person:
            persons.append(i)
        odd += weird
        shouted += loud
    near = sum(any(abs(i - p) <= NEAR for p in _around(persons, i)) for i, _ in weights)
    chars = max(len(text), 1)
    letters = max(chars - text.count(" "), 1)
    upper = len(text.encode()) - len(text.encode().translate(None, _CAPITALS))
    marks = len(text.encode()) - len(text.encode().translate(None, _MARKS))
    return [float(full), float(stems), 100.0 * (full + stems) / n,
            float(sum(w > 4 for _, w in weights)), float(near), float(masked), upper / letters,
            100.0 * shouted / n, marks / letters, 100.0 * text.count("!") / letters,
            100.0 * odd / n, math.log1p(len(words))]


_CAPITALS, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\"'()[]|*#%&$-_"
_NOTHING = ()


def _around(sorted_at: list[int], i: int) -> list[int]:
    from bisect import bisect

    k = bisect(sorted_at, i)
    return sorted_at[max(k - 1, 0):k + 1]


def _kind(word: str, lexicon: dict[str, float]) -> tuple:
    """(odds, 1 for a word and 2 for a beginning, masked, second person, odd, shouted), or nothing."""
    p = plain(word)
    weight, by = lexicon.get(p, 0.0), 1
    if not weight:
        weight, by = max((lexicon.get(f"{p[:n]}*", 0.0) for n in STEMS if len(p) > n), default=0.0), 2
    bare = word.strip(".,;:!?\"'()[]|*#%&$-")
    odd = bool(bare) and not bare.isalpha() and any(c.isalpha() for c in bare)
    kind = (weight, by if weight else 0, bool(weight) and odd, p in SECOND_PERSON, odd,
            len(bare) > 2 and bare.isupper())
    return kind if any(kind) else _NOTHING


def featured(docs: DataFrame, lexicon: dict[str, float]) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)     # LEXICON terms at most

    def measure(texts: pa.Array) -> pa.Array:
        known: dict[str, tuple] = {}
        return pa.array([features_of(t or "", shared.value, known) for t in texts.to_pylist()],
                        pa.list_(pa.float64()))

    return F.arrow_udf(measure, "array<double>")("text")


def scored(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``_held_out``, ``_score`` (calibrated, 0 to 1) and ``_predicted``.

    Only rows whose id's crc32 is not divisible by ``folds`` lend their labels,
    and of those at most ``sample``, the first by the hash of their id. Null
    text is empty and scored like any other. Without labels of both kinds the
    score is the one label there is, or 0. A document labelled twice counts
    twice; a null label does not. Repeated rows are scored one by one. Other
    columns pass through.
    """
    train = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != 0))
             .select("doc_id", F.col("toxic").cast("int").alias("label"), F.xxhash64("doc_id").alias("turn"))
             .orderBy("turn", "doc_id").limit(sample))
    # The sample is bounded, so its ids are; its texts are written once.
    known = settle(docs.select("doc_id", "text").join(F.broadcast(train), "doc_id"), "labelled")
    known = known.withColumn("half", F.col("turn").bitwiseAND(F.lit(1)).cast("int"))
    lexicons = learn_lexicons(known)
    rows = settle(known.select(
        F.when(F.col("half") == 0, featured(docs, lexicons[0])).otherwise(featured(docs, lexicons[1]))
        .alias("features"), "label",
        (F.shiftright("turn", 1).bitwiseAND(F.lit(3)) == 0).alias("calibrate")), "features")
    model = boosting.fit(rows, len(FEATURES))
    measured = docs.withColumn("_features", featured(docs, lexicons[2]))
    raw = model.raw([F.col("_features")[i] for i in range(len(FEATURES))])
    return (measured.withColumn("_raw", raw)
            .withColumn("_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), model.score(F.col("_raw")))))
            .withColumns({"_held_out": fold("doc_id", folds) == 0,
                          "_predicted": (F.col("_score") >= 0.5).cast("int")})
            .drop("_features", "_raw"))
