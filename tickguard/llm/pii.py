"""Personal data: base patterns, and further candidates that boosted trees select.

The base patterns with their checks (parts of an address, the Luhn sum, numbers of
digits) always count. Broad generators propose further, overlapping spans. Boosted
trees score those by their form and their surroundings, trained on the candidates
themselves: one is positive if the checked base finds it. The checks are not among
the features, so what looks like personal data and stands where personal data
stands scores high although a check rejects it. A calibrated threshold for each
kind selects, and selected spans that meet a base span or a better one go.

All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickguard.llm import boosting
from tickguard.session import settle

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.95          # of what a threshold lets through, on the calibration part
BEFORE, AFTER = 24, 8     # characters of context
STEPS = 1 << 10           # ranges of scores whose counts are summed on their own

_LOCAL = "A-Za-z0-9._%+-"
#: The base patterns. ``\G`` and the look-behind only start where the leftmost match
#: can start, and possessive repeats never go back, so long runs cost linear time.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Shorter runs of digits could not pass the check.
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What the generators take for a candidate of each kind.
BROAD = {
    "email": r"[\w.%+-]{1,64}\x20?(?:@|[(\[]\x20?at\x20?[)\]])\x20?[\w-]{1,63}"
             r"(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?[\w-]{1,63}){1,6}",
    "ip": r"(?<![0-9])[0-9]{1,4}(?:\x20?[.,:]\x20?[0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]{0,2}[0-9]){11,19}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?\x20?\(?[0-9]{1,4}\)?(?:[\x20.-]{0,2}\(?[0-9]{2,5}\)?){2,4}(?![0-9])",
}
#: A character without which a kind has no match at all.
NEEDS = {"email": "[@(\\[]", "ip": "[0-9]", "card": "[0-9]{2}", "phone": "[0-9]{2}"}
#: Words that announce a kind.
CUES = {"email": "mail|contact|write|@", "ip": "ip|host|server|address|login",
        "card": "card|visa|master|amex|pay|credit|number", "phone": "phone|tel|call|fax|mobile|cell"}

SPAN = "struct<kind:int,a:int,b:int>"
N_FEATURES = 16


def matches(text: Column, pattern: str, needs: str) -> Column:
    """array<struct<a, b, t>>: places (code points) and texts of all matches.

    What lies between the matches comes from a split by the same pattern; the
    places are the running lengths.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<a:int,b:int,t:string>>)").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        a = acc["at"] + F.length(pair["gap"])
        b = a + F.length(pair["hit"])
        more = F.array(F.struct(a.alias("a"), b.alias("b"), pair["hit"].alias("t")))
        return F.when(pair["hit"].isNull(), acc).otherwise(
            F.struct(b.alias("at"), F.concat(acc["out"], more).alias("out")))

    pairs = F.arrays_zip(between.alias("gap"), found.alias("hit"))
    placed = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(needs), placed).otherwise(
        F.expr("cast(array() as array<struct<a:int,b:int,t:string>>)"))


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(t: Column) -> Column:
    digits = F.split(F.reverse(_digits(t)), "")
    added = F.aggregate(
        F.transform(F.filter(digits, lambda d: d != ""), lambda d, i: F.when(
            i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda s, d: s + d)
    return added % 10 == 0


def checked(kind: str, t: Column) -> Column:
    n = F.length(_digits(t))
    if kind == "ip":
        return F.forall(F.split(t, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.try_to_number(F.right(F.concat(F.lit("000"), p), F.lit(3)), F.lit("999"))
                                      .cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return n.between(13, 19) & luhn(t)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<kind, a, b>> of the checked base, by kind, then start."""
    def of(number: int, kind: str) -> Column:
        good = F.filter(matches(text, BASE[kind], NEEDS[kind]), lambda m: checked(kind, m["t"]))
        return F.transform(good, lambda m: F.struct(F.lit(number).alias("kind"), m["a"].alias("a"), m["b"].alias("b")))

    return F.concat(*[of(i, kind) for i, kind in enumerate(KINDS)])


def candidate_spans(text: Column) -> Column:
    """array<struct<kind, a, b, f>>: the generators' proposals with their features."""
    def of(number: int, kind: str) -> Column:
        def featured(m: Column) -> Column:
            t = m["t"]
            from_ = F.greatest(m["a"] - BEFORE, F.lit(0))
            before = F.lower(F.substring(text, from_ + 1, m["a"] - from_))
            after = F.substring(text, m["b"] + 1, F.lit(AFTER))
            seps = F.regexp_replace(t, "[0-9A-Za-z]", "")
            groups = F.filter(F.split(t, "[^0-9A-Za-z]+"), lambda g: g != "")
            longest = F.array_max(F.transform(groups, F.length))
            shortest = F.array_min(F.transform(groups, F.length))

            def flag(c: Column) -> Column:
                return F.when(c, 1.0).otherwise(0.0)

            values = [
                F.lit(float(number)), F.length(t), F.length(_digits(t)), F.length(seps),
                F.size(groups), longest, shortest, F.size(F.array_distinct(F.split(seps, ""))),
                flag(t.startswith("+")), flag(F.contains(t, F.lit("("))), flag(F.contains(t, F.lit("@"))),
                flag(F.contains(t, F.lit("."))), flag(F.contains(t, F.lit(" "))),
                flag(before.rlike(CUES[kind])), flag(before.rlike(r"\s$") | (before == "")),
                flag(after.rlike(r"^[\s.,;]") | (after == ""))]
            features = F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])
            return F.struct(F.lit(number).alias("kind"), m["a"].alias("a"), m["b"].alias("b"), features.alias("f"))

        return F.transform(matches(text, BROAD[kind], NEEDS[kind]), featured)

    return F.concat(*[of(i, kind) for i, kind in enumerate(KINDS)])


def _meets(x: Column, y: Column) -> Column:
    return (x["a"] < y["b"]) & (y["a"] < x["b"])


class Selector:
    """The fitted trees and a threshold for each kind."""

    def __init__(self, candidates: DataFrame):
        """``candidates`` has kind, f, label and turn; two thirds of them are learned from, by turn, the rest calibrates."""
        rows = settle(candidates.select("kind", F.col("f").alias("features"), "label",
                                        (F.pmod(F.col("turn"), F.lit(3)) == 0).alias("calibrate")), "candidates")
        self.model = boosting.fit(rows.select("features", "label", "calibrate"), N_FEATURES, trees=15)
        held = (rows.filter("calibrate").select("kind", "label", self.score(F.col("features")).alias("score"))
                .groupBy("kind", "score").agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("all"))
                .withColumn("step", F.floor(F.col("score") * STEPS)))
        held = settle(held, "scores")
        # Cumulated from the top: the lowest score at which enough of what passes is right.
        # Whole steps are summed first, then the scores inside each.
        above = Window.partitionBy("kind").orderBy(F.desc("step"))
        sums = held.groupBy("kind", "step").agg(F.sum("right").alias("right"), F.sum("all").alias("all"))
        before = sums.select("kind", "step", *[(F.sum(c).over(above) - F.col(c)).alias(f"{c}_above")
                                               for c in ("right", "all")])
        top = Window.partitionBy("kind", "step").orderBy(F.desc("score"))
        passed = held.join(before, ["kind", "step"]).select(
            "kind", "score", *[(F.sum(c).over(top) + F.col(f"{c}_above")).alias(c) for c in ("right", "all")])
        cut = passed.filter(F.col("right") >= PRECISION * F.col("all")).groupBy("kind").agg(F.min("score").alias("at"))
        self.cuts = {r.kind: r.at for r in cut.collect()}

    def score(self, f: Column) -> Column:
        return self.model.score(self.model.raw([f[i] for i in range(N_FEATURES)]))

    def passes(self, c: Column) -> Column:
        cuts = F.array(*[F.lit(float(self.cuts.get(k, 2.0))) for k in range(len(KINDS))])
        return self.score(c["f"]) >= cuts[c["kind"]]


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``, both array<struct<kind, a, b>> in code points.

    Kinds count from 0 as in ``KINDS``; spans are by kind, then start. ``_spans``
    has the base and what the trees add. Null and empty texts have no spans.
    Repeated rows are looked at one by one. Without positive candidates nothing
    is added. Other columns pass through.
    """
    text = F.coalesce("text", F.lit(""))
    seen = settle(docs.withColumns({"_base": base_spans(text), "_cands": candidate_spans(text)}), "spans")
    # A candidate's turn is its text's, so that copies are drawn together.
    known = F.exists("_base", lambda b: (b["kind"] == F.col("c.kind")) & (b["a"] == F.col("c.a"))
                     & (b["b"] == F.col("c.b")))
    rows = (seen.filter(F.size("_cands") > 0)
            .select("_base", F.xxhash64("text").alias("turn"), F.explode("_cands").alias("c"))
            .select("c.*", known.cast("int").alias("label"), "turn"))
    selector = Selector(rows)
    chosen = F.filter("_cands", lambda c: selector.passes(c)
                      & ~F.exists("_base", lambda b: _meets(b, c)))
    # Of chosen spans that meet, the first kind's, then the leftmost stays.
    apart = F.aggregate(
        F.transform(chosen, lambda c: F.struct(c["kind"].alias("kind"), c["a"].alias("a"), c["b"].alias("b"))),
        F.expr(f"cast(array() as array<{SPAN}>)"),
        lambda acc, c: F.when(F.exists(acc, lambda o: _meets(o, c)), acc).otherwise(F.concat(acc, F.array(c))))
    return (seen.withColumn("_spans", F.array_sort(F.concat(F.col("_base"), apart)))
            .drop("_cands"))


def written(spans: str | Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["a"].cast("string"), s["b"].cast("string"))), ",")


def count_of(spans: str | Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: str | Column) -> Column:
    """The text with a mark such as ``[EMAIL]`` in place of each span; spans that meet share the first's."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"),
                                                                  s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    done = F.aggregate(by_place, start, lambda acc, s: F.when(
        s["a"] < acc["at"], F.struct(F.greatest(acc["at"], s["b"]).alias("at"), acc["out"].alias("out"))).otherwise(
        F.struct(s["b"].alias("at"), F.concat(acc["out"], F.array(
            F.substring(text, acc["at"] + 1, s["a"] - acc["at"]), marks[s["kind"]])).alias("out"))))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text))))
