"""Jobs to submit: convert a CSV table, report on it, train a model, publish the table in order, process the live stream.

    zip -r kerbstat.zip kerbstat
    spark-submit --py-files kerbstat.zip kerbstat/jobs.py convert --input raw.csv --output accidents
    spark-submit --py-files kerbstat.zip kerbstat/jobs.py report  --input accidents --output report
    spark-submit --py-files kerbstat.zip kerbstat/jobs.py train   --input accidents --output model --kind forest
    spark-submit --py-files kerbstat.zip kerbstat/jobs.py publish --input accidents --pause 1
    spark-submit --py-files kerbstat.zip kerbstat/jobs.py stream  --model model --output live
"""

from __future__ import annotations

import argparse
import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kerbstat.functions import clock
from kerbstat.operators import evaluation, models, splits
from kerbstat.operators.features import labelled
from kerbstat.plans import analytics, profile, reshaped, trends
from kerbstat.session import STATE_STORE, scratch_dir
from kerbstat.sources import files, messages
from kerbstat.streaming import alerts, replay, sinks, stateful

REPORT = {
    plan.__name__: plan
    for plan in (
        analytics.severity_heatmap,
        analytics.danger_score,
        analytics.weather_risk_bands,
        analytics.compound_risk,
        analytics.road_segments,
        analytics.rush_vs_offpeak,
        analytics.weather_severity,
        analytics.weather_avg,
        analytics.junction_signal,
        analytics.top_states,
        analytics.top_cities,
        analytics.top_cities_severe,
        analytics.severity_distribution,
        analytics.by_hour,
        analytics.by_year,
        analytics.avg_temp,
        analytics.common_weather,
        analytics.state_profile,
        analytics.weather_by_severity,
        analytics.state_map,
        reshaped.heatmap_pivot,
        reshaped.compound_pivot,
        profile.table_size,
        profile.null_profile,
        profile.numeric_summary,
        profile.severity_correlation,
        trends.week_over_week,
        trends.top_rolling_segments,
        trends.weather_correlation,
    )
}


def convert(spark: SparkSession, source: str, target: str) -> None:
    files.write_parquet(files.read_csv(spark, source), target, by_year=True)


def report(spark: SparkSession, source: str, target: str) -> None:
    """One Parquet folder per query. Each query reads only its own columns of the table."""
    table = files.read_parquet(spark, source)
    for name, plan in REPORT.items():
        plan(table).write.mode("overwrite").parquet(f"{target}/{name}")


TRAINERS = {
    "forest": (models.train_forest, models.score_forest),
    "weighted": (models.train_weighted_forest, models.score_weighted_forest),
    "boosted": (models.train_boosted, models.score_boosted),
}


def train(
    spark: SparkSession, source: str, target: str, kind: str = "forest", partitions: int | None = None, **parameters
) -> DataFrame:
    """Fit and store a model, and under ``results`` beside it what the rows it has not seen say of it.

    These are scored once; metrics, class report and confusion matrix come from their stored counts. The boosted
    model has a split that is exact within each class. Returns the metrics. ``parameters`` are the trainer's.
    """
    fit, score = TRAINERS[kind]
    table = files.read_parquet(spark, source)
    if kind == "boosted":
        training, test = splits.split_frames(splits.stratified_split(labelled(table)))
        training = training.drop("label")
    else:
        training, test = splits.hash_split(table)
        test = labelled(test)
    model = fit(training, partitions=partitions, **parameters)
    models.save_model(model, target)
    results = f"{target}/results"
    evaluation.confusion_counts(score(model, test)).write.mode("overwrite").parquet(f"{results}/counts")
    counts = spark.read.parquet(f"{results}/counts")
    tables = {
        "metrics": evaluation.overall_metrics(counts),
        "class_report": evaluation.class_report(counts),
        "confusion_matrix": evaluation.confusion_matrix(counts),
        "importances": models.feature_importance(model),
    }
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{results}/{name}")
    return spark.read.parquet(f"{results}/metrics")


HALF_WATERMARK = 300  # seconds: a reader's partitions may lie one range apart


def publish(
    spark: SparkSession, source: str, brokers: str, topic: str, ranges: int | None = None, pause: float = 0.0, longest: int = HALF_WATERMARK, rows_per_task: int = 100_000
) -> None:
    """Send the table to Kafka, one time range after the other, with ``pause`` seconds between them.

    Ranges are ``longest`` seconds long, by default half the watermark of the live job, so that none of their rows is late there even if the
    topic's partitions are read one range apart; those without rows are skipped, rows without a time come first. The rows of a range
    are sent by as many tasks as they need. The table is stored once by day, so that a range reads its day only. ``ranges`` asks for so many
    ranges of equal length instead; a reader then needs a watermark of twice their length.
    """
    table = files.read_parquet(spark, source)
    if ranges is not None:
        for chunk in replay.in_ranges(table, replay.even_boundaries(table, ranges)):
            messages.publish(chunk, brokers, topic=topic)
            time.sleep(pause)
        return
    folder, second = scratch_dir(spark, "publish"), clock.epoch_seconds(F.col("start_time"))
    table.withColumn("_day", F.to_date("start_time")).write.partitionBy("_day").parquet(folder)
    stored = spark.read.schema(T.StructType([*table.schema, T.StructField("_day", T.DateType())])).parquet(folder)
    # A row per range that has any: what the driver gets grows with the length of time, not with the rows.
    for row in sorted(replay.short_ranges(stored, longest).collect(), key=lambda r: (r["range"] is not None, r["range"] or 0)):
        if row["range"] is None:
            chunk = stored.filter("_day IS NULL")
        else:
            first = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=row["range"] * longest)
            days = sorted({first.date(), (first + dt.timedelta(seconds=longest - 1)).date()})
            chunk = stored.filter(F.col("_day").isin(days) & (F.floor(second / longest) == row["range"]))
        messages.publish(chunk.drop("_day").repartition(max(1, -(-row["rows"] // rows_per_task))), brokers, topic=topic)
        time.sleep(pause)


def process(events: DataFrame, target: str, model=None, every: str | None = None) -> list[StreamingQuery]:
    """Start all outputs of an accident stream.

    One query for the windows of all widths, of which the widest also become CSV files by state, and one each for alert files,
    running totals and the latest events. Checkpoints lie beside the outputs, so a restarted job goes on where it stopped.
    """
    scored = alerts.scored(events, model)
    beside = lambda name: {"checkpoint": f"{target}/_checkpoints/{name}", "every": every}
    started = []
    started.append(sinks.write_windows(stateful.all_windows(scored), target, f"{target}/by-state", **beside("windows")))
    started.append(sinks.write_alert_files(alerts.alerts(scored), f"{target}/alerts", **beside("alerts")))
    started.append(sinks.write_totals(alerts.running_totals(scored), f"{target}/totals", **beside("totals")))
    brief = scored.select("id", "start_time", "state", "predicted_severity")
    started.append(sinks.write_latest(brief, f"{target}/latest", alerts.latest_events, **beside("latest")))
    return started


def keep_malformed(parsed: DataFrame, target: str, every: str | None = None) -> StreamingQuery:
    """Start a query that stores the text of messages that did not parse."""
    lost = parsed.filter(F.col(messages.MALFORMED).isNotNull()).select(messages.MALFORMED)
    return sinks.write_parquet_stream(lost, f"{target}/malformed", checkpoint=f"{target}/_checkpoints/malformed", every=every)


def stream(
    spark: SparkSession, target: str, model_path: str | None, brokers: str, topic: str, max_offsets: int | None = None
) -> None:
    raw = messages.kafka_stream(spark, brokers, topic, max_offsets=max_offsets)
    parsed = messages.parse_messages(raw)
    events = parsed.filter(F.col(messages.MALFORMED).isNull()).drop(messages.MALFORMED)
    keep_malformed(parsed, target, every="10 seconds")
    model = models.load_model(model_path) if model_path else None
    process(events, target, model, every="10 seconds")
    spark.streams.awaitAnyTermination()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["convert", "report", "train", "publish", "stream"])
    parser.add_argument("--input")
    parser.add_argument("--output", help="all jobs but publish need it")
    parser.add_argument("--model")
    parser.add_argument("--brokers", default=messages.BROKERS)
    parser.add_argument("--topic", default=messages.TOPIC)
    parser.add_argument("--max-offsets", type=int, help="records of a micro-batch at most")
    parser.add_argument("--kind", choices=sorted(TRAINERS), default="forest", help="model to train")
    parser.add_argument("--partitions", type=int, help="tasks that train")
    parser.add_argument("--ranges", type=int, help="time ranges of equal length to publish, instead of ranges that fit the live job")
    parser.add_argument("--longest", type=int, default=HALF_WATERMARK, help="seconds of a published range")
    parser.add_argument("--pause", type=float, default=0.0, help="seconds between ranges")
    args = parser.parse_args()
    if args.output is None and args.job != "publish":
        parser.error("--output is missing")
    builder = SparkSession.builder.appName(f"kerbstat {args.job}").config(map=STATE_STORE)
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.job == "stream":
        stream(spark, args.output, args.model, args.brokers, args.topic, args.max_offsets)
    elif args.job == "train":
        train(spark, args.input, args.output, args.kind, args.partitions).show()
    elif args.job == "publish":
        publish(spark, args.input, args.brokers, args.topic, args.ranges, args.pause, args.longest)
    else:
        {"convert": convert, "report": report}[args.job](spark, args.input, args.output)


if __name__ == "__main__":
    main()
