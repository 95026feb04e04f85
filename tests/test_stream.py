"""Incremental intake."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from holdfast import schemas as S
from holdfast.operators.view360 import usage_totals
from holdfast.streaming import events


@pytest.fixture
def feed(spark, tmp_path):
    def write(name, days):
        start = datetime(2024, 1, 1)
        rows = [
            (d * 10 + i, f"c{i % 3}", start + timedelta(days=d, hours=i), "call" if i % 2 else "data",
             Decimal(i), Decimal(i * 2), "local" if i % 2 else None)
            for d in days for i in range(10)
        ]
        spark.createDataFrame(rows, S.CDR).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed" / name))
        return str(tmp_path / "feed")

    return write


def run(spark, path, tmp_path, lateness):
    return events.stream_ingest(spark, path, str(tmp_path / "out"), str(tmp_path / "state"), lateness)


def test_repeated_events_are_kept_once(spark, feed, tmp_path):
    feed("a", range(3))
    path = feed("b", range(3))
    run(spark, path, tmp_path, "60 days")
    run(spark, feed("c", range(2)), tmp_path, "60 days")
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == stored.select("event_id").distinct().count() == 30
    assert dict(stored.dtypes)["event_date"] == "timestamp_ntz"


def test_events_beyond_the_delay_are_counted_and_merged(spark, feed, tmp_path):
    path = feed("new", [20])
    assert run(spark, path, tmp_path, "1 hour") == 0
    assert run(spark, feed("old", [1]), tmp_path, "1 hour") == 10
    # Copies of events that were merged are late as well, and stay out.
    assert run(spark, feed("again", [1, 20]), tmp_path, "1 hour") >= 10
    stored = events.ingested(spark, str(tmp_path / "out"))
    assert stored.count() == stored.select("event_id").distinct().count() == 20
    assert dict(stored.dtypes)["event_date"] == "timestamp_ntz"


def test_late_events_without_an_id_are_merged_as_often_as_they_come(spark, tmp_path):
    def deliver(folder, day, copies):
        rows = spark.range(copies).selectExpr("null event_id", "'c' customer_id", f"timestamp_ntz'2024-01-{day} 10:00:00' event_date",
                                              "'sms' event_type", "null duration_mins", "null data_mb", "null call_type")
        rows.select(*[rows[f.name].cast(f.dataType) for f in S.CDR]).write.parquet(str(tmp_path / "feed" / folder))
        return run(spark, str(tmp_path / "feed"), tmp_path, "1 hour")

    assert deliver("new", 20, 3) == 0
    assert deliver("old", 10, 4) == 4
    assert deliver("older", 10, 2) == 2
    assert events.ingested(spark, str(tmp_path / "out")).count() == 9


def test_old_events_within_a_long_delay(spark, feed, tmp_path):
    run(spark, feed("new", [20]), tmp_path, "60 days")
    assert run(spark, feed("old", [1]), tmp_path, "60 days") == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_running_totals_follow_the_batch_result(spark, feed, tmp_path):
    target, state = str(tmp_path / "totals"), str(tmp_path / "totals-state")

    def check(folder):
        got = sorted(map(tuple, events.latest_totals(spark, folder).collect()))
        want = usage_totals(spark.read.option("recursiveFileLookup", True).schema(S.CDR).parquet(path))
        assert got == sorted(map(tuple, want.collect()))

    path = feed("a", [1])
    events.stream_usage_totals(spark, path, target, state)
    check(target)
    feed("b", [2, 3])
    events.stream_usage_totals(spark, path, target, state, files_per_trigger=1)
    check(target)
    compacted = events.compact_totals(spark, target, str(tmp_path / "compacted"))
    check(compacted)
    feed("c", [4])
    events.stream_usage_totals(spark, path, compacted, state)
    check(compacted)


def test_events_without_an_id_are_all_kept(spark, tmp_path):
    from holdfast import schemas as S

    feed = str(tmp_path / "feed")
    rows = spark.range(20).selectExpr(
        "if(id < 10, id, null) event_id", "'c' customer_id", "timestamp_ntz'2024-01-01 10:00:00' event_date", "'sms' event_type",
        "null duration_mins", "null data_mb", "null call_type")
    rows.select(*[rows[f.name].cast(f.dataType) for f in S.CDR]).write.parquet(feed)
    assert events.stream_ingest(spark, feed, str(tmp_path / "out"), str(tmp_path / "state")) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_late_events_read_only_the_days_they_touch(spark, feed, tmp_path):
    path = feed("new", [5, 20])
    assert run(spark, path, tmp_path, "1 hour") == 0
    # Files of day 20 (21 January) can't be read any more: a late run for day 5 must not open them.
    broken = list((tmp_path / "out" / "event_day=2024-01-21").glob("*.parquet"))
    assert broken
    for file in broken:
        file.write_bytes(b"x" * file.stat().st_size)
    assert run(spark, feed("old", [5, 3]), tmp_path, "1 hour") == 20
    assert run(spark, feed("again", [3]), tmp_path, "1 hour") == 10
    late = spark.read.parquet(str(tmp_path / "out-late"))
    assert sorted(r["event_id"] for r in late.collect()) == list(range(30, 40))


def test_a_run_that_failed_before_its_late_events_is_made_good(spark, feed, tmp_path, monkeypatch):
    path = feed("new", [20])
    run(spark, path, tmp_path, "1 hour")
    feed("old", [1])
    with monkeypatch.context() as patch:
        patch.setattr(events, "add_late", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            run(spark, path, tmp_path, "1 hour")
    assert events.ingested(spark, str(tmp_path / "out")).count() == 10
    run(spark, path, tmp_path, "1 hour")
    stored = events.ingested(spark, str(tmp_path / "out"))
    assert stored.count() == stored.select("event_id").distinct().count() == 20


def test_reading_totals_costs_the_same_after_many_batches(spark, tmp_path):
    target, folders = str(tmp_path / "totals"), []
    for number in range(200):
        batch = spark.range(number % 7, 12, 3, 1).selectExpr("concat('c', id) customer_id", f"{number} total_calls")
        # A repeated batch changes nothing, be it one that folds (95) or not.
        for _ in range(2 if number in (90, 95) else 1):
            events.keep_totals(batch, target, number)
        folders.append(len(events.total_folders(spark, target)[1]))
    assert max(folders) < events.FOLD_BATCHES and len(list((tmp_path / "totals").iterdir())) <= 3 * events.FOLD_BATCHES
    want = {f"c{i}": n for n in range(200) for i in range(n % 7, 12, 3)}
    assert {r[0]: r[1] for r in events.latest_totals(spark, target).collect()} == want
