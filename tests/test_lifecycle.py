"""Runs that never ended, with late events and a restart."""

from datetime import datetime, timedelta

from filingmill import cli
from filingmill.sources.store import Lake

START = datetime(2026, 1, 1)
EVENTS = "extraction_run_id string, report_id string, run_started_at timestamp, run_finished_at timestamp, status string, pipeline_version string, rule_pack_version string, extractor_versions map<string,string>, error_message string"


def append(lake, *events):
    """Events of (run, minute of the beginning, minute of the end or None, status)."""
    at = lambda m: None if m is None else START + timedelta(minutes=m)
    rows = [(run, "r", at(began), at(end), status, "v", "p", {}, None) for run, began, end, status in events]
    lake.append("extraction_runs", lake.spark.createDataFrame(rows, EVENTS))


def statuses(lake):
    return {r["extraction_run_id"]: (r["status"], (r["run_finished_at"] - START).total_seconds() / 60 if r["run_finished_at"] else None) for r in cli.run_events(lake).collect()}


def test_overdue_runs_fail_after_late_events_and_a_restart(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.initialize(2)
    watch = lambda: cli.main(["watch-runs", "--lake", lake.root, "--limit-minutes", "60", "--delay-minutes", "10"], spark)
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    append(lake, ("dead", 0, None, "running"), ("slow", 1, None, "running"), ("done", 2, None, "running"), ("done", 2, 20, "succeeded"))
    assert watch() == "running=2 succeeded=1 failed=0"
    # the stream's time is 55: the end of slow, of minute 58, is late but within the delay, and comes before its beginning is overdue
    append(lake, ("other", 65, None, "running"))
    assert watch() == "running=3 succeeded=1 failed=0"
    append(lake, ("slow", 1, 58, "succeeded"))
    lake.compact("extraction_runs")  # shows all events again
    append(lake, ("other", 65, 75, "succeeded"), ("last", 75, None, "running"))
    watch()
    assert statuses(lake) == {"dead": ("failed", 60), "slow": ("succeeded", 58), "done": ("succeeded", 20), "other": ("succeeded", 75), "last": ("running", None)}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    # an end that the stream passes over as too late is in the lake, which is asked before anything is written
    append(lake, ("far", 300, None, "running"), ("far", 300, 310, "succeeded"), ("last", 75, 80, "succeeded"))
    watch()
    assert statuses(lake)["last"] == ("succeeded", 80) and statuses(lake)["dead"] == ("failed", 60)
