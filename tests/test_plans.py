"""What the physical plans must and must not contain."""

import os
import re

import pytest

from tickguard.operators import volatility
from tickguard.plans.catalog import QUERIES, RULE, SPEC
from tickguard.sources.tables import events_as_trades
from tickguard.sources.trades import watched

SF = os.environ.get("TICKGUARD_SF", "/root/testdata/sf0.001")
BATCH = [name for name in sorted(QUERIES) if not name.startswith("stream_")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cartesian_no_unsplit_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            assert "SinglePartition" not in "".join(lines[i:i + 4])


def test_scan_reads_only_the_needed_columns(spark):
    text = plan(volatility.volatility_alerts(events_as_trades(spark, SF), SPEC, RULE))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {
        "ts:timestamp_ntz,event_type:string,value:double"}


def test_watch_list_reaches_the_scan(spark):
    text = plan(watched(events_as_trades(spark, SF), ["click", "view"]))
    assert "PushedFilters: [In(event_type, [click,view])]" in text


def test_trades_are_shuffled_once_per_pane_not_per_window(spark):
    text = plan(volatility.volatility_alerts(events_as_trades(spark, SF), SPEC, RULE))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_avg" in text and "Expand" not in text
