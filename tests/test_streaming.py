"""Streams against batch results."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from kerbstat.operators import models
from kerbstat.session import scratch_dir, scratch_root
from kerbstat.sources import messages
from kerbstat.session import STATE_STORE
from kerbstat.streaming import alerts, replay, sinks, stateful, windows


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def replayed(spark, path, files_per_batch=1):
    raw = replay.message_stream(spark, path, files_per_batch)
    return messages.parse_messages(raw).drop(messages.MALFORMED)


@pytest.mark.parametrize("width", windows.WIDTHS)
def test_ordered_replay_in_batches_equals_batch(spark, small, tmp_path, width):
    path = str(tmp_path / "messages")
    edges = [dt.datetime(2024, 1, d) for d in (8, 15, 22)]
    replay.write_chunks(small, path, edges, end_marker=True)
    streamed = replay.run_to_table(windows.windowed_severity(replayed(spark, path), width), "test")
    assert rows(streamed) == rows(windows.windowed_severity(small, width))
    assert streamed.count() > 0


def test_chunks_of_several_files_release_together(spark, small, tmp_path):
    path = str(tmp_path / "messages")
    replay.write_chunks(small, path, [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)], files_per_chunk=3, end_marker=True)
    assert len([f for f in os.listdir(path) if f.endswith(".txt")]) == 10
    stream = windows.windowed_severity(replayed(spark, path, 3), "60 minutes")
    assert rows(replay.run_to_table(stream, "test")) == rows(windows.windowed_severity(small, "60 minutes"))


def test_row_beyond_the_watermark_is_dropped(spark, make, tmp_path):
    noon = dt.datetime(2024, 1, 1, 12)
    minute = lambda m: noon + dt.timedelta(minutes=m)
    path = str(tmp_path / "messages")
    # Lateness is judged by the watermark of the batch before: minute 6 is late, 21 is not.
    batches = [[0, 3], [30], [31], [6, 21], [60]]
    for i, batch in enumerate(batches):
        df = make([{"id": f"{i}-{m}", "severity": 2, "state": "X", "start_time": minute(m)} for m in batch])
        messages.to_messages(df).select("value").coalesce(1).write.mode("append").text(path)
    replay.write_end_marker(spark, path)
    stream = windows.windowed_severity(replayed(spark, path), "5 minutes")
    found = {(r.window_start - noon).seconds // 60: r.accidents for r in replay.run_to_table(stream, "test").collect()}
    assert found == {0: 2, 30: 2, 20: 1, 60: 1}


def test_csv_folders_by_state(spark, small, tmp_path):
    events = replay.as_stream(small, end_marker={})
    stream = windows.windowed_severity(events, "60 minutes")
    path = str(tmp_path / "by-state")
    sinks.write_csv_by_state(stream, path).awaitTermination()
    states = {d for d in os.listdir(path) if d.startswith("state=")}
    batch = windows.windowed_severity(small, "60 minutes")
    assert states == {f"state={r.state}" for r in batch.select("state").distinct().collect()}
    assert rows(sinks.read_csv_by_state(spark, path, stream.schema)) == rows(batch)


def test_restart_from_a_checkpoint_reads_nothing_twice(spark, small, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("messages", "out", "checkpoint"))
    replay.write_chunks(small.filter("start_time < '2024-01-15'"), path, [])
    start = lambda: sinks.write_parquet_stream(replayed(spark, path), out, checkpoint=checkpoint).awaitTermination()
    start()
    replay.write_chunks(small.filter("start_time >= '2024-01-15'"), path, [])
    start()
    assert spark.read.parquet(out).count() == small.filter("start_time IS NOT NULL").count()


def test_state_shrinks_from_range_to_range(spark, small, tmp_path):
    events = replay.as_stream(small, end_marker={})
    query = sinks.write_parquet_stream(windows.windowed_severity(events, "60 minutes"), str(tmp_path / "out"))
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    windows_in_all = windows.windowed_severity(small, "60 minutes").count()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 5
    assert max(held) < windows_in_all / 2 and held[-1] == 1  # the end marker's


def test_ranges_hold_every_row_once(spark, make):
    day = lambda d: dt.datetime(2024, 1, d)
    table = make([{"id": str(i), "severity": i % 4, "start_time": t} for i, t in enumerate([day(1), day(2), day(3), day(9), None, day(9)])])
    chunks = replay.in_ranges(table, replay.even_boundaries(table, 4))
    assert [sorted(r.id for r in c.collect()) for c in chunks] == [["0", "1", "4"], ["2"], [], ["3", "5"]]
    held_back = replay.in_ranges(table, replay.even_boundaries(table, 4), late=F.col("id").isin("0", "2"))
    assert [sorted(r.id for r in c.collect()) for c in held_back] == [["1", "4"], ["2"], [], ["0", "3", "5"]]
    assert replay.even_boundaries(table.filter("id = '4'"), 4) == []


def test_a_repeated_batch_changes_nothing(spark, small, tmp_path):
    """Sinks that replace their result give the same when a batch comes again."""
    path, seen = str(tmp_path / "latest"), []
    brief = alerts.scored(replay.as_stream(small)).select("id", "start_time", "state", "predicted_severity")

    class Twice:
        def __init__(self, writer):
            self.writer = writer

        def foreachBatch(self, write):
            def twice(batch, number):
                write(batch, number)
                write(batch, number)
                seen.append(number)

            return self.writer.foreachBatch(twice)

    class Stream:
        def __init__(self, df):
            self.sparkSession, self.writeStream = df.sparkSession, Twice(df.writeStream)

    sinks.write_latest(Stream(brief), path, alerts.latest_events).awaitTermination()
    assert seen == [0, 1, 2, 3]
    wanted = alerts.latest_events(alerts.scored(small).select(*brief.columns)).collect()
    assert sinks.read_latest(spark, path, alerts.latest_events).collect() == wanted


def test_alerts_and_threshold(spark, small):
    scored = alerts.scored(small)
    for threshold in (1, 2, 3, 4):
        found = alerts.alerts(scored, threshold)
        assert found.count() == scored.filter(F.col("predicted_severity") >= threshold).count()
    labels = {r.severity_label for r in alerts.alerts(scored).select("severity_label").distinct().collect()}
    assert labels <= {"Serious", "Critical"} and labels


def test_running_totals_as_a_stream(spark, small):
    stream = alerts.running_totals(alerts.scored(replay.as_stream(small)))
    query = (
        stream.writeStream.outputMode("complete").format("memory").queryName("totals")
        .option("checkpointLocation", scratch_dir(spark, "totals")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("totals").first() == alerts.running_totals(alerts.scored(small)).first()


def test_latest_events_newest_first(small):
    latest = alerts.latest_events(small).collect()
    times = [r.start_time for r in latest]
    assert len(latest) == 12 and times == sorted(times, reverse=True)
    assert times[0] == small.agg(F.max("start_time")).first()[0]


def test_model_scores_a_stream(spark, small):
    model = models.train_forest(small, trees=3, depth=3)
    stream = alerts.scored(replay.as_stream(small), model)
    streamed = replay.run_to_table(stream.select("id", "predicted_severity"), "test")
    assert rows(streamed) == rows(alerts.scored(small, model).select("id", "predicted_severity"))


def test_scratch_follows_the_session_setting(spark):
    root = scratch_root(spark)
    setting = spark.conf.get("spark.checkpoint.dir", None)
    assert setting is None or root == setting.rstrip("/")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


class Kept:
    """A state value as the engine would hold it."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_rolling_state_is_bounded_by_the_window():
    import numpy as np
    import pandas as pd

    rng, handle, rolling = np.random.default_rng(1), Kept(), stateful.Rolling(60)
    rolling.init(handle)
    seconds = np.flatnonzero(rng.random(2_000) < 0.7)
    table = pd.DataFrame({"second": seconds, "n": rng.integers(1, 4, len(seconds)), "total": 5, "severe": rng.integers(0, 2, len(seconds))})
    found = []
    for part in np.array_split(np.arange(len(table)), 40):
        rows = table.iloc[rng.permutation(part)]
        found += list(rolling.handleInputRows(("s", None, "x"), iter([rows.iloc[:5], rows.iloc[5:]]), None))
        assert len(handle.value[0]) <= 60 and len(handle.timers) == 1
    out = pd.concat(found)
    wanted = [table[(table["second"] > s - 60) & (table["second"] <= s)][["n", "severe"]].sum().tolist() for s in table["second"]]
    assert out[["accidents", "severe_accidents"]].to_numpy().tolist() == wanted and out["second"].tolist() == seconds.tolist()
    list(rolling.handleExpiredTimer(("s", None, "x"), None, None))
    assert handle.value is None


def test_all_widths_read_the_stream_once(spark, small, tmp_path):
    events = replay.as_stream(small, end_marker={})
    found = stateful.all_windows(events)
    query = sinks.write_windows(found, str(tmp_path / "out"), str(tmp_path / "csv"))
    query.awaitTermination()
    stored = sinks.read_windows(spark, str(tmp_path / "out"), found.schema)
    for minutes, width in zip(stateful.WIDTH_MINUTES, windows.WIDTHS):
        wanted = rows(windows.windowed_severity(small, width))
        assert rows(stored.filter(F.col("width_minutes") == minutes).drop("width_minutes")) == wanted
    assert sum(p["numInputRows"] for p in query.recentProgress) == small.count() + 1, "each event is read once"
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == windows.windowed_severity(small, "60 minutes").count()


def test_own_state_needs_no_setting_of_the_session(spark, small, make, tmp_path):
    (key,) = STATE_STORE
    before = spark.conf.get(key, None)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    noon = dt.datetime(2024, 5, 1, 12)
    events = make([{"id": str(i), "severity": 3, "street": "a", "city": None, "state": "x", "start_time": noon + dt.timedelta(minutes=5 * i)} for i in range(6)])
    try:
        spark.conf.set(key, plain)
        rolled = replay.run_to_table(stateful.rolling_severity_stream(replay.as_stream(events, end_marker={"street": "end"})), "test", own_state=True)
        assert [r.accidents for r in rolled.orderBy("second").collect()] == [1, 2, 3, 3, 3, 3]
        found = stateful.all_windows(replay.as_stream(events, end_marker={}))
        sinks.write_windows(found, str(tmp_path / "out"), str(tmp_path / "csv")).awaitTermination()
        assert sinks.read_windows(spark, str(tmp_path / "out"), found.schema).groupBy("width_minutes").count().count() == 3
        assert spark.conf.get(key) == plain
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_ranges_of_equal_rows(spark, make):
    start = dt.datetime(2024, 1, 1)
    times = [start + dt.timedelta(seconds=i) for i in range(90)] + [start + dt.timedelta(days=30 + i) for i in range(10)] + [None]
    table = make([{"id": str(i), "start_time": t} for i, t in enumerate(times)])
    sizes = [c.count() for c in replay.in_ranges(table, replay.row_boundaries(table, 4))]
    assert sum(sizes) == 101 and max(sizes) <= 30
    assert replay.row_boundaries(table.filter("id = '3'"), 4) == [] == replay.row_boundaries(table.limit(0), 4)
    pieces = {r["range"]: r["rows"] for r in replay.short_ranges(table, 60).collect()}
    assert pieces[None] == 1 and sorted(pieces.values())[-2:] == [30, 60] and len(pieces) == 13
