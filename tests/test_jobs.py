"""The submitted jobs, end to end on a CSV file."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from kerbstat import jobs
from kerbstat.operators import models
from kerbstat.sources import files, messages
from kerbstat.streaming import alerts, replay, sinks, stateful, windows


def test_from_csv_to_alerts(spark, small, tmp_path):
    at = lambda name: str(tmp_path / name)
    files.write_csv(small, at("raw"))
    jobs.convert(spark, at("raw"), at("table"))
    table = files.read_parquet(spark, at("table"))
    assert table.count() == small.count()

    jobs.report(spark, at("table"), at("report"))
    assert set(os.listdir(at("report"))) == set(jobs.REPORT)
    assert spark.read.parquet(at("report") + "/severity_distribution").count() == 4

    metrics = jobs.train(spark, at("table"), at("model")).first()
    assert metrics.accuracy > 0.8
    results = lambda name: spark.read.parquet(f"{at('model')}/results/{name}")
    assert results("importances").count() == 11
    assert results("class_report").count() == 4 and results("confusion_matrix").count() == 4

    replay.write_chunks(small, at("topic"), [], end_marker=True)
    events = messages.parse_messages(replay.message_stream(spark, at("topic"))).drop(messages.MALFORMED)
    for query in jobs.process(events, at("live"), models.load_model(at("model"))):
        query.awaitTermination()
    outputs = {d for d in os.listdir(at("live")) if not d.startswith("_")}
    assert outputs == {"windows", "by-state", "alerts", "totals", "latest"}
    totals = sinks.read_totals(spark, at("live") + "/totals").first()
    undated = small.count() - small.filter("start_time IS NOT NULL").count()
    # The end marker is a record; like the undated ones it has a row, and a time that the model can read.
    assert (totals.records, totals.unscored) == (small.count() + 1, undated)
    latest = sinks.read_latest(spark, at("live") + "/latest", alerts.latest_events).collect()
    assert len(latest) == 12 and latest[0].start_time == replay.END_OF_STREAM
    by_state = spark.read.option("header", True).csv(at("live") + "/by-state")
    live = sinks.read_windows(spark, at("live"), stateful.all_windows(alerts.scored(events)).schema)
    assert by_state.count() == live.filter("width_minutes = 60").count() > 0
    assert spark.read.json(at("live") + "/alerts").filter("predicted_severity < 3").count() == 0
    # Rows come out once, except those in windows that the model cannot score: it skips none with a time.
    dated = small.filter("start_time IS NOT NULL").count()
    for width in stateful.WIDTH_MINUTES:
        assert live.filter(F.col("width_minutes") == width).groupBy().sum("accidents").first()[0] == dated


def test_malformed_messages_are_kept(spark, small, tmp_path):
    texts = messages.to_messages(small.limit(5)).select("value").unionByName(spark.createDataFrame([("{no json",)], "value string"))
    texts.write.text(str(tmp_path / "topic"))
    parsed = messages.parse_messages(spark.readStream.text(str(tmp_path / "topic")))
    jobs.keep_malformed(parsed, str(tmp_path / "live")).awaitTermination()
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "live" / "malformed")).collect()] == ["{no json"]


@pytest.mark.parametrize("kind, parameters", [("weighted", {"trees": 3, "depth": 4}), ("boosted", {"rounds": 1, "depth": 2})])
def test_other_models_train_and_report(spark, small, tmp_path, kind, parameters):
    small.write.parquet(str(tmp_path / "table"))
    metrics = jobs.train(spark, str(tmp_path / "table"), str(tmp_path / "model"), kind, partitions=2, **parameters)
    assert 0 <= metrics.first().accuracy <= 1
    for name in ("class_report", "confusion_matrix", "importances"):
        assert spark.read.parquet(str(tmp_path / "model" / "results" / name)).count() > 0
    assert models.load_model(str(tmp_path / "model")) is not None


def test_publishing_goes_range_by_range(spark, small, tmp_path, monkeypatch):
    small.write.parquet(str(tmp_path / "table"))
    sent = []
    monkeypatch.setattr(messages, "publish", lambda df, brokers, topic: sent.append(df.agg(F.min("start_time"), F.max("start_time"), F.count("*")).first()))
    jobs.publish(spark, str(tmp_path / "table"), "nowhere:1", "topic", ranges=5)
    assert len(sent) == 5 and sum(s[2] for s in sent) == small.count()
    assert all(a[1] < b[0] for a, b in zip(sent, sent[1:]))


def test_what_is_published_by_default_is_late_for_no_live_window(spark, small, tmp_path, monkeypatch):
    """Three partitions of a topic as folders of files; each micro-batch reads what was sent of one range, and one partition lags by a range."""
    day = small.filter("start_time IS NULL OR to_date(start_time) IN ('2024-01-05', '2024-01-06')")
    day.write.parquet(str(tmp_path / "table"))
    sent = []

    def send(df, brokers, topic):
        low, high, n = df.agg(F.min("start_time"), F.max("start_time"), F.count("*")).first()
        sent.append((low, high, n, messages.to_messages(df).select("value", "key").collect()))

    monkeypatch.setattr(messages, "publish", send)
    jobs.publish(spark, str(tmp_path / "table"), "nowhere:1", "topic")
    dated = [s for s in sent if s[0]]
    assert sum(s[2] for s in sent) == day.count() and all((s[1] - s[0]).total_seconds() < jobs.HALF_WATERMARK for s in dated)
    assert all(a[1] < b[0] for a, b in zip(dated, dated[1:])) and len(dated) > 20
    late, path = [], str(tmp_path / "topic")
    for i, (*_, rows) in enumerate([*dated, (None, None, 0, [])]):
        now = late + [r.value for r in rows if hash(r.key) % 3]
        late = [r.value for r in rows if not hash(r.key) % 3]
        if now:
            os.makedirs(path, exist_ok=True)
            with open(f"{path}/{i:04}.txt", "w", encoding="utf-8") as file:
                file.write("\n".join(now) + "\n")
            os.utime(f"{path}/{i:04}.txt", (1_000_000 + i, 1_000_000 + i))
    replay.write_end_marker(spark, path)
    events = messages.parse_messages(replay.message_stream(spark, path, 1)).drop(messages.MALFORMED)
    found = replay.run_to_table(windows.windowed_severity(events, "5 minutes"), "published")
    assert found.groupBy().sum("accidents").first()[0] == sum(s[2] for s in dated)
