"""Edge rows and invariants of the detectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tickguard.operators import volatility as V
from tickguard.operators import zscore as Z
from tickguard.operators.trailing import fitting_blocks, trailing_stats, trailing_zscores
from tickguard.operators.windows import direct_sliding_stats, sliding_stats
from tickguard.params import VolatilityRule, WindowSpec, ZScoreRule
from support import at, rows_of

SPEC = WindowSpec()
ONE = WindowSpec(60, 60)


def random_trades(n, symbols=("A", "B", None), seconds=900, seed=3, ties=False):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        when = rnd.randrange(seconds) if ties else rnd.randrange(seconds * 1000) / 1000
        price = None if rnd.random() < 0.05 else round(100 + rnd.gauss(0, 3), 2)
        rows.append((rnd.choice(symbols), price, when, rnd.randrange(9)))
    return rows


def close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9))


@pytest.mark.parametrize("spec", [SPEC, WindowSpec(60, 20), WindowSpec(50, 10), WindowSpec(600, 10)])
def test_merged_panes_equal_plain_windows(trades, spec):
    df = trades(random_trades(120, seconds=3000) + [("A", 5, -30), ("A", 7, -31.5)])
    keys = ("symbol", "window_start", "window_end")
    got = {tuple(r[k] for k in keys): r for r in sliding_stats(df, spec).collect()}
    want = {tuple(r[k] for k in keys): r for r in direct_sliding_stats(df, spec).collect()}
    assert got.keys() == want.keys() and len(got) > 100
    for key, r in want.items():
        assert got[key]["count_trades"] == r["count_trades"]
        assert close(got[key]["mean_price"], r["mean_price"])
        assert close(got[key]["stddev_price"], r["stddev_price"])


def test_slide_that_does_not_divide_the_window(trades):
    stats = sliding_stats(trades(random_trades(50)), WindowSpec(60, 25))
    assert {(r.window_end - r.window_start).seconds for r in stats.collect()} == {60}


def test_every_event_is_in_six_windows(trades):
    stats = sliding_stats(trades([("A", 1, 5)]), SPEC).collect()
    assert sorted(r.window_start for r in stats) == [at_naive(s) for s in range(-50, 10, 10)]


def at_naive(seconds):
    return at(seconds).replace(tzinfo=None)


def test_small_spread_on_a_large_mean_survives_the_merge(trades):
    rows = [("A", 79581.0 + 0.001 * (i % 3), i) for i in range(60)]
    got = sliding_stats(trades(rows), SPEC).filter("count_trades = 60").first()
    exact = direct_sliding_stats(trades(rows), SPEC).filter("count_trades = 60").first()
    assert math.isclose(got.stddev_price, exact.stddev_price, rel_tol=1e-6)


def test_constant_price_has_no_spread_and_no_alert(trades):
    rows = [("A", 0.1, i * 3.1) for i in range(40)]
    stats = sliding_stats(trades(rows), SPEC).filter("count_trades > 1")
    assert stats.filter("stddev_price <> 0").count() == 0
    assert V.volatility_alerts(trades(rows), SPEC).count() == 0


def test_single_trade_windows_have_no_spread(trades):
    stats = sliding_stats(trades([("A", 5, 0)]), ONE).first()
    assert (stats.count_trades, stats.mean_price, stats.stddev_price) == (1, 5.0, None)


def test_zero_mean_is_infinitely_volatile_and_negative_mean_never(trades):
    rows = [("zero", -1, 1), ("zero", 1, 2), ("neg", -5, 1), ("neg", -6, 2)]
    alerts = V.volatility_alerts(trades(rows), ONE).collect()
    assert [(r.symbol, r.volatility_ratio) for r in alerts] == [("zero", math.inf)]


def test_threshold_is_strict(trades):
    stats = sliding_stats(trades([("A", 1, 1), ("A", 3, 2)]), ONE)
    ratio = V.rated_windows(stats, VolatilityRule()).first().volatility_ratio
    rated = V.rated_windows(stats, VolatilityRule())
    assert V.over_threshold(rated, VolatilityRule(threshold=ratio)).count() == 0
    assert V.over_threshold(rated, VolatilityRule(threshold=ratio - 1e-9)).count() == 1


def test_nan_price_is_missing_everywhere(trades):
    base = [("A", 10 + i % 2, i) for i in range(20)]
    dirty = trades(base + [("A", float("nan"), 3.5), ("A", None, 4.5)])
    clean = trades(base)
    assert rows_of(sliding_stats(dirty, SPEC)) == rows_of(sliding_stats(clean, SPEC))
    scored = Z.score_batch(dirty)
    assert scored.count() == 22
    assert scored.agg(F.max("count_trades")).first()[0] == 20
    assert scored.filter("abs(z_score) > 3").count() == 0


def test_null_symbol_is_volatile_but_never_scored(trades):
    rows = [(None, p, i) for i, p in enumerate([1.0] * 30 + [99.0])]
    assert V.volatility_alerts(trades(rows), SPEC).count() > 0
    assert Z.batch_zscores(trades(rows)).count() == 0
    assert Z.sliding_zscores(trades(rows), SPEC).count() == 0


def test_null_time_is_in_no_window_but_is_scored(trades):
    rows = [("A", 1, None)] * 30 + [("A", 50, None)]
    assert sliding_stats(trades(rows), SPEC).count() == 0
    assert Z.batch_zscores(trades(rows)).count() == 1


@pytest.mark.parametrize("n,alerts,z", [(10, 0, None), (11, 1, 10 / math.sqrt(11)), (81, 1, 80 / 9)])
def test_largest_possible_z_score(trades, n, alerts, z):
    rows = [("A", 100, i / 100) for i in range(n - 1)] + [("A", 101, 5)]
    found = Z.batch_zscores(trades(rows)).collect()
    assert len(found) == alerts
    if alerts:
        assert math.isclose(found[0].z_score, z, rel_tol=1e-9)
        assert found[0].count_trades == n


def test_both_tails_and_bound(trades):
    rows = random_trades(300, symbols=("A", "B")) + [("A", 140, 1), ("B", 60, 2)]
    found = Z.batch_zscores(trades(rows)).collect()
    assert {r.z_score > 0 for r in found} == {True, False}
    for r in found:
        assert 3 < abs(r.z_score) <= (r.count_trades - 1) / math.sqrt(r.count_trades) + 1e-9
        assert math.isclose(r.z_score, (r.price - r.mean_price) / r.stddev_price, rel_tol=1e-9)


@pytest.mark.parametrize("sizes", [{}, {"broadcast_bytes": 0, "hot_rows": 7}])
def test_sliding_zscores_equal_brute_force(trades, sizes):
    rows = random_trades(260, symbols=("A", "B", None), seconds=150) + [
        ("A", 130, 60), ("A", 130, 60), ("B", 71, 75.5)]
    df = trades(rows)
    spec = WindowSpec(60, 10)
    stats = direct_sliding_stats(df, spec).filter("symbol is not null").collect()
    want = []
    for s in stats:
        if s.count_trades < 5 or not s.stddev_price:
            continue
        for symbol, price, second, volume in ((*r, 1)[:4] for r in rows):
            if symbol == s.symbol and price is not None \
                    and s.window_start <= at_naive(second) < s.window_end \
                    and abs(price - s.mean_price) / s.stddev_price > 3:
                want.append((at_naive(second), symbol, float(price), s.window_start))
    got = Z.sliding_zscores(df, spec, **sizes)
    assert rows_of(got, "event_time", "symbol", "price", "window_start") == sorted(want, key=repr)
    assert len(want) > 10


def brute_trailing(rows, span, rule=ZScoreRule()):
    out = []
    known = [(r[0], float(r[1]), r[2]) for r in rows if r[0] is not None and r[1] is not None]
    for symbol, price, when in known:
        near = [p for s, p, t in known if s == symbol and when - span - 1e-9 <= t <= when + 1e-9]
        n = len(near)
        if n < rule.min_trades or min(near) == max(near):
            continue
        mean = sum(near) / n
        sd = math.sqrt(sum((p - mean) ** 2 for p in near) / (n - 1))
        if abs(price - mean) / sd > rule.threshold:
            out.append((at_naive(when), symbol, price, n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ties", [True, False])
@pytest.mark.parametrize("blocks", [1, 2, 6])
def test_trailing_zscores_equal_brute_force(trades, ties, blocks):
    rows = random_trades(300, seconds=400, ties=ties) + [
        ("A", 140, 200), ("A", 140, 200), ("B", 60, 399), ("A", 77, 120), ("B", 131, -90)]
    got = trailing_zscores(trades(rows), 60, blocks=blocks)
    want = brute_trailing(rows, 60)
    assert rows_of(got, "event_time", "symbol", "price", "count_trades") == want
    assert len(want) >= 2


def test_busy_blocks_are_cut_shorter(trades):
    df = trades([("A", 1, i / 100) for i in range(900)] + [("B", 1, 1)])
    assert fitting_blocks(df, 60) == 6
    assert fitting_blocks(df, 60, rows_per_block=300) == 20
    assert fitting_blocks(trades([]), 60) == 6
    assert 60_000_000 % fitting_blocks(df, 60, rows_per_block=1) == 0


def test_trailing_range_includes_both_ends(trades):
    df = trades([("A", 1, 0), ("A", 2, 60), ("A", 4, 60.001)])
    counts = [r.count_trades for r in trailing_stats(df, 60).orderBy("event_time").collect()]
    assert counts == [1, 2, 2]


def test_trailing_constant_run_before_a_jump_has_no_spread(trades):
    rows = [("A", 0.1, i) for i in range(20)] + [("A", 1e6, 20)]
    flat = trailing_stats(trades(rows), 60).filter("count_trades between 2 and 20")
    assert flat.filter("stddev_price = 0").count() == 19


def test_revisions_end_at_the_full_window(trades):
    df = trades(random_trades(200, seconds=200))
    spec = WindowSpec(60, 10)
    last = (V.revised_stats(df, spec, 20).groupBy("symbol", "window_start")
            .agg(F.max_by("count_trades", "batch_id").alias("n")))
    full = sliding_stats(df, spec).select("symbol", "window_start", F.col("count_trades").alias("n"))
    assert rows_of(last) == rows_of(full)


def test_revision_batches_must_hold_whole_slides(trades):
    with pytest.raises(ValueError):
        V.revised_stats(trades([("A", 1, 1)]), SPEC, 15)


def test_empty_input_gives_empty_output(trades):
    none = trades([])
    assert V.volatility_alerts(none).count() == 0
    assert Z.batch_zscores(none).count() == 0
    assert Z.sliding_zscores(none).count() == 0
    assert trailing_zscores(none, 60).count() == 0
