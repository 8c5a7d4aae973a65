"""Alert files, deduplication and reports."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickguard.functions.scalars import age_text, second_stamp
from tickguard.operators import dedup
from tickguard.plans import reports
from tickguard.schema import VOLATILITY_ALERT, ZSCORE_ALERT
from tickguard.sources import alerts as files
from tickguard.streaming import sinks
from support import rows_of

T0 = datetime(2024, 1, 1)
T1 = datetime(2024, 1, 1, 0, 1)


@pytest.fixture
def zalerts(spark):
    return spark.createDataFrame([
        (T0, "A", 10.0, 1.0, 5.0, 1.0, 20, 5.0), (T0, "A", 10.0, 2.0, 5.0, 1.0, 20, 5.0),
        (T1, "B", 1.0, 1.0, 5.0, 1.0, 20, -4.0), (None, None, 1.0, 1.0, 5.0, 1.0, 20, 3.5)],
        ZSCORE_ALERT)


@pytest.fixture
def revisions(spark):
    return spark.createDataFrame([
        (T0, T1, "A", 2, 5.0, 1.0, 0.2, 0), (T0, T1, "A", 3, 5.5, 1.0, 0.18, 1),
        (T0, T1, "A", 3, 5.5, 1.0, 0.18, 2), (T0, T1, "B", 9, 5.0, 1.0, 0.2, 0)],
        files.T.StructType([*VOLATILITY_ALERT.fields, files.T.StructField("batch_id", files.T.LongType())]))


def test_dedup_of_revisions(revisions):
    first = dedup.first_volatility_alerts(revisions)
    assert rows_of(first, "symbol", "count_trades", "batch_id") == [
        ("A", 2, 0), ("A", 3, 1), ("B", 9, 0)]
    assert first.columns == revisions.columns
    last = dedup.latest_revision(revisions)
    assert rows_of(last, "symbol", "count_trades", "batch_id") == [("A", 3, 2), ("B", 9, 0)]


def test_dedup_collapses_trades_of_one_instant_and_price(zalerts):
    kept = dedup.first_zscore_alerts(zalerts)
    assert rows_of(kept, "symbol", "volume") == [("A", 1.0), ("B", 1.0), (None, 1.0)]
    only_symbol = dedup.first_zscore_alerts(zalerts.drop("event_time", "price"))
    assert only_symbol.count() == 3
    assert dedup.keep_first(zalerts, ["absent"], []).count() == 4


def test_flat_files_are_read_by_family(spark, tmp_path):
    (tmp_path / "alerts_batch_5_one.csv").write_text(
        ",".join(VOLATILITY_ALERT.names) + "\n"
        "2024-01-01 00:00:00,2024-01-01 00:01:00,A,3,5.5,1.0,0.18\n")
    (tmp_path / "alerts_batch_6_two.csv").write_text("")
    (tmp_path / "zscore_alerts_batch_7_three.csv").write_text(
        ",".join(ZSCORE_ALERT.names) + "\n2024-01-01 00:00:00.858,A,10.0,1.0,5.0,1.0,20,5.0\n")
    volatile = files.read_flat_alerts(spark, str(tmp_path), "volatility")
    scored = files.read_flat_alerts(spark, str(tmp_path), "zscore")
    assert rows_of(volatile, "symbol", "count_trades", "batch_id") == [("A", 3, 5)]
    assert rows_of(scored, "event_time", "batch_id") == [
        (datetime(2024, 1, 1, 0, 0, 0, 858000), 7)]
    both = files.union_alerts({"volatility": volatile, "zscore": scored})
    assert rows_of(both, "family", "z_score") == [("volatility", None), ("zscore", 5.0)]


def test_alert_sink_replaces_its_batch_and_skips_empty_ones(spark, zalerts, tmp_path):
    root = str(tmp_path / "alerts")
    sinks.write_alerts(zalerts, root, 3)
    sinks.write_alerts(zalerts.limit(1), root, 4)
    sinks.write_alerts(zalerts.limit(0), root, 5)
    sinks.write_alerts(zalerts, root, 3)
    back = files.read_alerts(spark, root, ZSCORE_ALERT)
    assert rows_of(back.groupBy("batch_id").count()) == [(3, 4), (4, 1)]
    assert rows_of(back.filter("batch_id = 3").drop("batch_id")) == rows_of(zalerts)


def test_flat_files_match_by_name_and_odd_ones_are_listed(spark, tmp_path):
    names = ZSCORE_ALERT.names
    values = ["2024-01-01 00:00:00.858", "A", "10.0", "1.0", "5.0", "1.0", "20", "5.0"]
    def save(name, *lines):
        (tmp_path / f"zscore_alerts_batch_{name}.csv").write_text("\n".join(lines) + "\n")
    save("1", ",".join(names), ",".join(values))
    save("2", ",".join(reversed(names)), ",".join(reversed(values)))
    save("3", ",".join(names[:-1]), ",".join(values[:-1]))
    save("4", ",".join(names), ",".join(values), "2024-01-01 00:00:00,A")       # a cut line
    (tmp_path / "zscore_alerts_batch_5.csv").write_bytes(b"\x00\xff\x1f\x8b no header, here\n")
    back = files.read_flat_alerts(spark, str(tmp_path), "zscore")
    assert rows_of(back, "batch_id", "symbol", "price", "z_score") == [
        (1, "A", 10.0, 5.0), (2, "A", 10.0, 5.0), (3, "A", 10.0, None), (4, "A", 10.0, 5.0)]
    assert back.count() == 4
    odd = files.unreadable_flat_alerts(spark, str(tmp_path), "zscore")
    assert [(f.rsplit("/", 1)[-1], n) for f, n in rows_of(odd)] == [
        ("zscore_alerts_batch_4.csv", 1), ("zscore_alerts_batch_5.csv", 1)]


def test_flat_files_with_quotes_line_ends_and_other_columns(spark, tmp_path):
    names = ZSCORE_ALERT.names
    when = "2024-01-01 00:00:00.858"
    rest = "10.0,1.0,5.0,1.0,20,5.0"
    def save(name, *lines):
        (tmp_path / f"zscore_alerts_batch_{name}.csv").write_text("\n".join(lines) + "\n")
    save("1", ",".join(names), f'{when},"A,B",{rest}', f'{when},"C ""D""",{rest}')
    save("2", ",".join(names), f'{when},"E\nF",{rest}')
    save("3", "note," + ",".join(names), f'"odd, this",{when},G,{rest}')
    save("4", "symbol,z_score", "H,5.0", "I,x")
    catalogue = files.header_catalogue(spark, str(tmp_path), "zscore").collect()
    assert sorted(len(row.files) for row in catalogue) == [1, 1, 2]
    back = files.read_flat_alerts(spark, str(tmp_path), "zscore")
    assert rows_of(back, "batch_id", "symbol", "price", "z_score") == [
        (1, "A,B", 10.0, 5.0), (1, 'C "D"', 10.0, 5.0), (2, "E\nF", 10.0, 5.0), (3, "G", 10.0, 5.0),
        (4, "H", None, 5.0), (4, "I", None, None)]
    assert back.columns == [*names, "batch_id"]
    extras = files.read_flat_alerts(spark, str(tmp_path), "zscore", extras=True)
    assert rows_of(extras.filter("note is not null"), "symbol", "note") == [("G", "odd, this")]
    assert files.unreadable_flat_alerts(spark, str(tmp_path), "zscore").count() == 0


def test_folders_that_are_not_there_yet_have_no_alerts(spark, tmp_path):
    absent = str(tmp_path / "absent")
    assert files.read_flat_alerts(spark, absent, "zscore").count() == 0
    assert files.unreadable_flat_alerts(spark, absent, "volatility").count() == 0
    back = files.read_alerts(spark, absent, ZSCORE_ALERT)
    assert back.count() == 0 and back.columns == [*ZSCORE_ALERT.names, "batch_id"]


def test_a_replay_without_alerts_leaves_none(spark, zalerts, tmp_path):
    root = str(tmp_path / "alerts")
    sinks.write_alerts(zalerts, root, 3)
    sinks.write_alerts(zalerts.limit(0), root, 3)
    assert files.read_alerts(spark, root, ZSCORE_ALERT).count() == 0
    assert not (tmp_path / "alerts" / "batch_id=3").exists()


def test_own_files_that_do_not_fit_are_an_error(spark, zalerts, tmp_path):
    root = str(tmp_path / "alerts")
    sinks.write_alerts(zalerts.select(*reversed(zalerts.columns)), root, 1)
    with pytest.raises(Exception, match="CSV header|FAILED_READ_FILE"):
        files.read_alerts(spark, root, ZSCORE_ALERT).collect()


def test_kpis(spark, zalerts):
    kpi = reports.zscore_kpis(zalerts).first()
    assert (kpi.alerts, kpi.symbols, kpi.max_abs_z, kpi.max_abs_z_text) == (4, 2, 5.0, "5.00")
    none = reports.zscore_kpis(zalerts.limit(0)).first()
    assert (none.alerts, none.symbols, none.max_abs_z_text) == (0, 0, "—")
    empty = reports.volatility_kpis(spark.createDataFrame([], VOLATILITY_ALERT)).first()
    assert (empty.alerts, empty.symbols, empty.age) == (0, 0, "—")


@pytest.mark.parametrize("seconds,text", [
    (0, "0s"), (59.9, "59s"), (60, "1min"), (3599.9, "59min"), (3600, "1h"), (90000, "25h")])
def test_age_text(spark, seconds, text):
    now = F.timestamp_micros(F.lit(int(1_700_000_000_100_000 + seconds * 1_000_000)))
    latest = F.timestamp_micros(F.lit(1_700_000_000_100_000))
    assert spark.range(1).select(age_text(now, latest)).first()[0] == text


def test_filters_are_inclusive_and_drop_nulls(zalerts):
    assert reports.filtered(zalerts, reports.Z_SIZE, ["A", "B"], 4.0, 5.0).count() == 3
    shown = reports.shown_of_total(zalerts, reports.Z_SIZE, ["A"], 5.0, 5.0).first()
    assert (shown.shown, shown.total) == (2, 4)


def test_orders(zalerts):
    newest = [r.event_time for r in reports.newest_first(zalerts, "event_time", "volume").collect()]
    assert newest == [T1, T0, T0, None]
    oldest = [r.event_time for r in reports.oldest_first(zalerts, "event_time", "volume").collect()]
    assert oldest == [T0, T0, T1, None]


def test_counts_bounds_symbols_columns(zalerts):
    assert [tuple(r) for r in reports.count_by_symbol(zalerts).collect()] == [("A", 2), ("B", 1)]
    assert tuple(reports.bounds(zalerts, reports.Z_SIZE).first()) == (3.5, 5.0)
    assert [r.symbol for r in reports.symbols(zalerts).collect()] == [None, "A", "B"]
    assert reports.present_columns(zalerts.drop("volume")).columns == [
        "event_time", "symbol", "price", "mean_price", "stddev_price", "z_score"]


def test_histogram_has_both_edges_and_no_join(spark):
    df = spark.createDataFrame(
        [("A", float(v)) for v in [0, 1, 2, 29.5, 30]] + [("B", float("nan"))],
        "symbol string, z_score double")
    bins = reports.histogram(df)
    assert rows_of(bins, "bin", "alerts") == [(1, 1), (2, 1), (3, 1), (30, 2)]
    assert "Join" not in bins._jdf.queryExecution().executedPlan().toString()
    assert rows_of(reports.histogram(df.filter("z_score = 1")), "bin", "alerts") == [(1, 1)]
    assert reports.histogram(df.limit(0)).count() == 0


def test_band(zalerts):
    band = reports.sigma_band(zalerts).first()
    assert (band.band_low, band.band_high) == (2.0, 8.0)


def test_stamped_export(spark, zalerts, tmp_path):
    stamp = spark.range(1).select(second_stamp(F.lit(T1).cast("timestamp"))).first()[0]
    path = sinks.export_csv(zalerts, str(tmp_path), stamp)
    assert path.endswith("anomalies_20240101_000100")
    back = spark.read.schema(ZSCORE_ALERT).option("header", "true").csv(path)
    assert rows_of(back) == rows_of(zalerts)
