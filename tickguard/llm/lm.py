"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Words are counted over all training texts. The most frequent ones are the model's
own classes; all others share the class ``RARE``, inside which a word has its
add-one unigram chance. The log-bilinear model predicts a class from the class
before: a context vector times a target vector plus a bias. Class pairs are counted
over all training texts, and numpy fits the model to the counts by
noise-contrastive estimation. One batched matrix product per block of contexts
then normalises all contexts, which leaves a bounded table of log probabilities.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickguard.llm.common import fold, utf8
from tickguard.llm.quality import rounded
from tickguard.session import settle

CLASSES = 1024            # the end mark, RARE, and the most frequent words
HEAD = 1 << 17            # words whose counts every task has; the others' counts are joined
WIDTH, NOISE, STEPS, RATE = 32, 64, 120, 0.03
PRIOR = 50                # tokens that every context is taken to have been followed by
END, RARE = 0, 1
#: Stands for the end mark among the words; no word is empty.
END_WORD = b""
PARTIAL = 1 << 20         # distinct words that a task counts before it passes them on


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush():
        words, n = list(counts), list(counts.values())
        counts.clear()
        for at in range(0, len(words), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[at:at + (1 << 16)], pa.binary()), pa.array(n[at:at + (1 << 16)], pa.int64())],
                ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in utf8(batch.column(0)):
            counts.update(text.lower().split())
            counts[END_WORD] += 1
            if len(counts) > PARTIAL:
                yield from flush()
    yield from flush()


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over all whole texts, the end mark among them."""
    return (training.select("text").mapInArrow(_count_words, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _pairs(head: dict[bytes, tuple]):
    """Counts of neighbouring classes, per task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CLASSES * CLASSES, np.int64)
        waiting: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in utf8(batch.column(0)):
                ids = _classes(text.lower().split(), head.value)
                waiting.append(ids[:-1] * CLASSES + ids[1:])
                held += len(ids)
                if held > 1 << 20:
                    cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
                    waiting, held = [], 0
        if waiting:
            cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at // CLASSES), pa.array(at % CLASSES), pa.array(cells[at])], ["a", "b", "n"])

    return count


def _classes(words: list[bytes], head: dict[bytes, tuple]) -> np.ndarray:
    """The end mark, each word's class, the end mark."""
    get, rare = head.get, (RARE,)
    ids = np.empty(len(words) + 2, np.int64)
    ids[0] = ids[-1] = END
    ids[1:-1] = np.fromiter((get(w, rare)[0] for w in words), np.int64, len(words))
    return ids


class LogBilinear:
    """P(b | a) in proportion to exp(context[a] . target[b] + bias[b])."""

    def __init__(self, size: int, width: int = WIDTH, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.context = rng.normal(0, 0.1, (size, width)).astype(np.float32)
        self.target = rng.normal(0, 0.1, (size, width)).astype(np.float32)
        self.bias = np.zeros(size, np.float32)

    def fit(self, pairs: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> None:
        """Noise-contrastive estimation on pair counts, with the unigrams as noise.

        Each pair is told from ``NOISE`` noise targets of its context, while the
        model's scores count as normalised. The counts are all there is to know of
        the texts, and there are few classes, so the objective's expectation over
        the noise is summed over all targets instead of drawn. Adam takes the steps.
        """
        size = len(self.bias)
        seen = np.zeros((size, size), np.float32)
        seen[pairs[:, 0], pairs[:, 1]] = counts
        noise = (seen.sum(0) + 1).astype(np.float32)
        noise /= noise.sum()
        # Contexts that are hardly seen keep to the unigrams.
        seen += PRIOR * noise
        seen /= seen.sum()
        fake = seen.sum(1)[:, None] * (NOISE * noise)
        log_kq = np.log(NOISE * noise)
        self.bias[:] = np.log(noise)
        values = [self.context, self.target, self.bias]
        first, second = ([np.zeros_like(v) for v in values] for _ in range(2))
        for step in range(1, steps + 1):
            odds = self.context @ self.target.T
            odds += self.bias - log_kq
            real = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))     # the chance that a target is no noise
            pull = seen - (seen + fake) * real
            grads = [pull @ self.target, pull.T @ self.context, pull.sum(0)]
            for v, grad, m, s in zip(values, grads, first, second, strict=True):
                m += 0.1 * (grad - m)
                s += 0.01 * (grad * grad - s)
                v += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-12)

    def log10(self, block: int = 256) -> np.ndarray:
        """The normalised log probabilities of all targets after all contexts."""
        out = np.empty((len(self.bias), len(self.bias)), np.float32)
        for at in range(0, len(out), block):
            scores = (self.context[at:at + block] @ self.target.T + self.bias).astype(np.float64)
            top = scores.max(1, keepdims=True)
            scores -= top + np.log(np.exp(scores - top).sum(1, keepdims=True))
            out[at:at + block] = scores / math.log(10)
        return out


SCORED = ("struct<n_tokens:bigint,n_known:bigint,counted:double,model:double,n_rare:bigint,"
          "rare:double,far:array<struct<word:binary,n:bigint>>>")


def _scorer(head, table):
    """Per text: what the head words and the class table tell, and the words to look up."""
    far_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def score(texts: pa.Array) -> pa.Array:
        known, log10s = head.value, table.value.ravel()
        end_n = known[END_WORD][1] if END_WORD in known else 0
        cols: list[list] = [[] for _ in range(7)]
        for text in utf8(texts):
            words = text.lower().split()
            ids = _classes(words, known)
            cells = ids[:-1] * CLASSES + ids[1:]
            get = known.get
            n_known, counted, n_rare, rare, far = int(end_n > 0), math.log10(end_n + 1), 0, 0.0, []
            for w, n in Counter(words).items():
                entry = get(w)
                if entry is None:
                    far.append({"word": w, "n": n})
                    n_rare += n
                    continue
                logged = n * entry[2]
                n_known += n
                counted += logged
                if entry[0] == RARE:
                    n_rare += n
                    rare += logged
            values = (len(words) + 1, n_known, counted, float(log10s[cells].sum(dtype=np.float64)),
                      n_rare, rare, far)
            for col, v in zip(cols, values, strict=True):
                col.append(v)
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), far_type]
        names = ["n_tokens", "n_known", "counted", "model", "n_rare", "rare", "far"]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return score


def _head_cut(counts: DataFrame) -> int:
    """The least count such that no more than ``HEAD`` words have it; from a histogram of few bins."""
    bins = counts.groupBy(rounded("n").alias("bin")).count().collect()
    cut, words = 1 << 62, 0
    for row in sorted(bins, reverse=True):
        words += row["count"]
        if words > HEAD:
            break
        cut = row.bin
    return cut


def score(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Documents whose id's crc32 modulo ``folds`` is ``held`` are held out of all
    counts and of the model. ``base_score`` is the add-one unigram log10
    probability, ``score`` the model's. Null text is empty: one token, the end
    mark. Repeated rows count and are scored one by one. Without training
    documents all counts are zero. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    training = docs.filter(fold("doc_id", folds) != held)
    counts = settle(word_counts(training), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # At most HEAD words and the end mark, whatever the corpus; a task holds them once.
    top = (counts.filter((F.col("n") >= _head_cut(counts)) | (F.col("word") == F.lit(END_WORD)))
           .toPandas().sort_values(["n", "word"], ascending=[False, True]))
    head: dict[bytes, tuple] = {}
    classed = {END_WORD: END}
    for word, n in zip(top["word"], top["n"], strict=True):
        word = bytes(word)
        if word != END_WORD and len(classed) < CLASSES - 1:
            classed[word] = len(classed) + 1
        head[word] = (classed.get(word, RARE), int(n), math.log10(int(n) + 1))
    rare_total = total - sum(n for c, n, _ in head.values() if c != RARE)
    rare_distinct = distinct - sum(c != RARE for c, _, _ in head.values())
    shared = spark.sparkContext.broadcast(head)

    rows = (training.select("text").mapInArrow(_pairs(shared), "a bigint, b bigint, n bigint")
            .groupBy("a", "b").agg(F.sum("n").alias("n")).toPandas())     # CLASSES squared at most
    model = LogBilinear(CLASSES)
    if len(rows):
        rows = rows.sort_values(["a", "b"])
        model.fit(rows[["a", "b"]].to_numpy(), rows["n"].to_numpy())
    table = spark.sparkContext.broadcast(model.log10())

    whole, rare_whole = total + distinct + 1, rare_total + rare_distinct + 1
    parts = settle(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                    F.arrow_udf(_scorer(shared, table), SCORED)("text").alias("s"))
        .select("row", "doc_id", "s.*"), "scored")
    looked_up = (parts.select("row", F.inline("far"))
                 .join(counts.withColumnRenamed("n", "c"), "word")
                 .groupBy("row").agg(F.sum("n").alias("found"),
                                     F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("logged")))
    found, logged = F.coalesce("found", F.lit(0)), F.coalesce("logged", F.lit(0.0))

    def minus(n: str, of: int) -> Column:
        return F.col(n) * F.lit(math.log10(of))

    return parts.join(looked_up, "row", "left").select(
        "doc_id", (fold("doc_id", folds) == held).alias("held_out"), "n_tokens",
        (F.col("n_known") + found).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("counted") + logged - minus("n_tokens", whole)).alias("base_score"),
        (F.col("model") + F.col("rare") + logged - minus("n_rare", rare_whole)).alias("score"))
