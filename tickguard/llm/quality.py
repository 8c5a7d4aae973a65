"""Quality rules whose limits come from the data: quantile sketches per language and source.

A sketch counts values that are rounded down to six significant bits, so it is
exact below 64 and within 1/32 above, and two sketches merge by adding counts.
"""

from __future__ import annotations

from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickguard.llm.common import utf8
from tickguard.session import settle

SYMBOLS = b"#*$%&|<>"
SPAN = 5                  # words of a repeated window
MIN_WORDS, REPEAT_PERCENT = 10, 20
MIN_GROUP = 200           # documents; smaller groups take the limits of their language
SPREAD = 3.0              # quartile ranges beyond the quartile
BITS = 6
#: Metric: whether low values fail too, and the least room beyond the quartile.
METRICS = {"word_centichars": (True, 200), "symbol_rate": (False, 200),
           "dup_line_rate": (False, 3000), "repeat_rate": (False, 1500)}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _repeated(words: list[bytes]) -> int:
    """Words inside windows that occur twice or more."""
    windows = list(zip(*(islice(words, k, None) for k in range(SPAN)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + SPAN - max(i, upto)
            upto = i + SPAN
    return covered


def _count(text: bytes) -> tuple[int, ...]:
    words = text.split()
    body = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(body.decode()), len(body) - len(body.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), _repeated(words))


COUNTED = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def text_counts(texts: pa.Array) -> pa.Array:
    rows = [_count(t) for t in utf8(texts)]
    columns = list(zip(*rows, strict=True)) or [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)


def _per(part: str, whole: str) -> Column:
    """Ten thousandths, as a whole number; nothing of nothing is zero."""
    return F.expr(f"coalesce({part} * 10000 div nullif({whole}, 0), 0)")


def metrics(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "word_centichars": F.expr("coalesce(word_chars * 100 div nullif(n_words, 0), 0)"),
        "symbol_rate": _per("n_symbols", "word_chars"),
        "dup_line_rate": _per("n_dup_lines", "n_lines"),
        "repeat_rate": _per("n_repeat_words", "n_words"),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))})


def rounded(value: str) -> Column:
    """The sketch's bin: ``value`` with all but its six leading bits cleared."""
    drop = f"cast(greatest(length(bin({value})) - {BITS}, 0) as int)"
    return F.expr(f"shiftleft(shiftright({value}, {drop}), {drop})")


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, metric, bin, n): counts that combine before the shuffle and add up."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), rounded(m).alias("bin")) for m in METRICS])
    return (measured.select(*groups, F.inline(pairs))
            .groupBy(*groups, "metric", "bin").agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, metric, total, q1, q3): the first bins at which the counts reach a quarter of the total."""
    whole = Window.partitionBy(*groups, "metric")
    ranked = sketch.withColumns({
        "upto": F.sum("n").over(whole.orderBy("bin")), "total": F.sum("n").over(whole)})
    return ranked.groupBy(*groups, "metric").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bin"))).alias("q3"))


def limits(measured: DataFrame) -> DataFrame:
    """(lang, source, metric limits): from the group's own sketch, or its language's if it is small."""
    own = settle(sketches(measured, ["lang", "source"]), "sketch")
    of_lang = own.groupBy("lang", "metric", "bin").agg(F.sum("n").alias("n"))
    small = F.col("total") < MIN_GROUP
    joined = quartiles(own, ["lang", "source"]).join(
        quartiles(of_lang, ["lang"]).select("lang", "metric", F.col("q1").alias("lang_q1"),
                                            F.col("q3").alias("lang_q3")), ["lang", "metric"])
    q1, q3 = F.when(small, F.col("lang_q1")).otherwise(F.col("q1")), \
        F.when(small, F.col("lang_q3")).otherwise(F.col("q3"))
    room = F.create_map(*[F.lit(x) for m, (_, least) in METRICS.items() for x in (m, least)])
    reach = F.greatest(F.lit(SPREAD) * (q3 - q1), room[F.col("metric")])
    made = joined.select("lang", "source", "metric", (q3 + reach).alias("high"), (q1 - reach).alias("low"))
    picked = [F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{m}_{side}")
              for m, (both, _) in METRICS.items() for side in (["low", "high"] if both else ["high"])]
    return made.groupBy("lang", "source").agg(*picked)


def judge(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, lang, source, the counts and rates, base_failed and kept.

    Documents that fail the fixed base rule, and those beyond a limit of their
    group, are not kept. A limit lies three quartile ranges outside the group's
    quartiles, and at least ``METRICS``' room outside them.

    Null text is empty and fails the base rule; a null language or source is a
    group of its own. Repeated rows count and are judged one by one. An empty
    table gives an empty table. Other columns are not read.
    """
    measured = settle(metrics(
        docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"),
                    F.coalesce("source", F.lit("")).alias("source"),
                    F.arrow_udf(text_counts, COUNTED)("text").alias("counts"))
        .select("doc_id", "lang", "source", "counts.*")), "measured")
    fine = ~F.col("base_failed")
    for m, (both, _) in METRICS.items():
        fine &= F.col(m) <= F.col(f"{m}_high")
        if both:
            fine &= F.col(m) >= F.col(f"{m}_low")
    return (measured.join(limits(measured.filter("n_words > 0")), ["lang", "source"], "left")
            .withColumn("kept", F.coalesce(fine, F.lit(False))))
