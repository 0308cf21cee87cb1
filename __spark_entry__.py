
from __future__ import annotations

import importlib
import os
import sys
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The package lies beside this file, wherever the file is loaded from.
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbstat.functions import clock, flags, labels, risk
from kerbstat.operators import evaluation, features, models, rules, splits
from kerbstat.plans import analytics, profile, reshaped, trends
from kerbstat.session import scratch_dir
from kerbstat.sources import driver_tables, files, messages
from kerbstat.streaming import alerts, replay, sinks, stateful, windows


def _optional(name: str):
    """The operators on texts and vectors, and the pipeline over them, or packages that they need, may be absent; all else works without."""
    try:
        return importlib.import_module(name)
    except ImportError as missing:
        if getattr(missing, "name", None) not in (name, "kerbstat.llm"):
            warnings.warn(f"{name} is left out: {missing}", stacklevel=2)
        return None


llm, corpus_pipeline = _optional("kerbstat.llm.registry"), _optional("corpus_pipeline")

FLAGSHIP_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """States by danger score on the smallest data set."""
    return analytics.danger_score(driver_tables.accidents(spark, FLAGSHIP_DIR), min_count=100)


# --- queries that need more than one call ----------------------------------------------


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles summed in task order differ in their last digits from run to run."""
    return df.select([F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _time_features(df: DataFrame) -> DataFrame:
    time = F.col("start_time")
    return df.select(
        "id",
        clock.hour_of_day(time).alias("hour_of_day"),
        clock.weekday_from_sunday(time).alias("day_from_sunday"),
        clock.weekday_from_monday(time).alias("day_from_monday"),
        clock.weekday_from_sunday_zero(time).alias("day_from_sunday_zero"),
        clock.month_of_year(time).alias("month"),
        clock.calendar_year(time).alias("year"),
        clock.weekday_name(time).alias("day_name"),
        clock.weekday_name(time, short=True).alias("short_day_name"),
        clock.time_band(time).alias("time_of_day"),
        clock.rush_period(time).alias("time_period"),
    )


def _flag_features(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        flags.severe_flag(F.col("severity")).alias("is_severe"),
        flags.night_flag(F.col("sunrise_sunset")).alias("is_night"),
        flags.flag(F.col("junction")).alias("junction_int"),
        flags.text_flag(F.col("traffic_signal")).alias("traffic_signal_int"),
        flags.text_flag(F.initcap(F.col("crossing").cast("string"))).alias("crossing_int"),
        flags.text_flag(F.col("weather_condition")).alias("weather_as_flag"),
    )


def _road_type_labels(df: DataFrame) -> DataFrame:
    level = F.col("severity")
    return df.select(
        "id",
        labels.road_type(F.col("junction"), F.col("traffic_signal")).alias("road_type"),
        labels.place_label(F.col("street"), F.col("city")).alias("road_label"),
        labels.severity_label(level).alias("severity_label"),
        labels.severity_description(level).alias("severity_description"),
        labels.severity_duration(level).alias("severity_duration"),
        labels.severity_response(level).alias("severity_response"),
    )


def _risk_score(df: DataFrame) -> DataFrame:
    base = risk.rule_risk(
        F.col("visibility_mi"), F.col("distance_mi"), F.col("humidity_pct"), F.col("wind_speed_mph")
    )
    return rules.score_by_rule(df).select(
        "id",
        base.alias("base_risk"),
        "risk",
        "predicted_severity",
        *[f"probability_s{c}" for c in (1, 2, 3, 4)],
        risk.rule_severity(base).alias("base_severity"),
    )


def _all_rule_counts(df: DataFrame) -> DataFrame:
    return evaluation.confusion_counts(rules.score_by_rule(features.labelled(df)))


def _rule_counts(df: DataFrame) -> DataFrame:
    return _all_rule_counts(df).filter(F.col("prediction").isNotNull())


def _csv_round_trip(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_dir(spark, "csv")
    files.write_csv(df, path)
    return files.read_csv(spark, path)


def _parquet_round_trip(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_dir(spark, "parquet")
    files.write_parquet(df, path, by_year=True)
    return files.read_parquet(spark, path)


def _json_round_trip(df: DataFrame) -> DataFrame:
    return messages.parse_messages(messages.to_messages(df), df.schema)


def _csv_quoted_round_trip(df: DataFrame) -> DataFrame:
    """Texts with quotes and commas, as files hold them, come back unchanged."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "csv-quoted")
    quoted = F.concat(F.lit('at "'), "state", F.lit('", lane '), "city")
    files.write_csv(df.select("id", quoted.alias("street"), "severity"), path)
    return files.read_csv(spark, path)


def _view_sql(df: DataFrame) -> DataFrame:
    """SQL text over the published headers."""
    files.register_view(df, "accidents_by_header", header_names=True)
    return df.sparkSession.sql(
        "SELECT State AS state, COUNT(*) AS accidents, MAX(`Temperature(F)`) AS warmest FROM accidents_by_header GROUP BY State"
    )


def _time_columns(df: DataFrame) -> DataFrame:
    return files.add_time_columns(df).select("id", "hour", "month", "day_of_week", "year")


def _lenient_times(df: DataFrame) -> DataFrame:
    """Times as text, every seventh hour spoilt."""
    text = F.date_format("start_time", "yyyy-MM-dd HH:mm:ss")
    spoilt = F.when(F.hour("start_time") % 7 == 0, F.concat(F.lit("about "), text)).otherwise(text)
    return df.select("id", clock.lenient_timestamp(spoilt).alias("start_time"))


def _rule_unscored(df: DataFrame) -> DataFrame:
    """Rows that the rule metrics cannot speak of, per true level."""
    missing = F.col("prediction").isNull()
    return rules.score_by_rule(df).groupBy("severity").agg(F.count("*").alias("rows"), F.count_if(missing).alias("unscored"))


def _stratified_split(df: DataFrame) -> DataFrame:
    return splits.stratified_split(features.labelled(df)).select("id", "severity", "split")


def _hash_split(df: DataFrame) -> DataFrame:
    train, test = splits.hash_split(df)
    side = lambda part, name: part.select("id", F.lit(name).alias("split"))
    return side(train, "train").unionByName(side(test, "test"))


def _class_weights(df: DataFrame) -> DataFrame:
    return features.class_weights(features.labelled(features.weighted_frame(df))).select(
        F.col("label").cast("int").alias("label"), "rows", "weight"
    )


def _forest_features(df: DataFrame) -> DataFrame:
    return features.labelled(features.forest_frame(df)).select("id", *features.FOREST_FEATURES, "label")


def _boosted_features(df: DataFrame) -> DataFrame:
    frame = features.boosted_frame(df)
    coded = features.category_encoder().fit(frame).transform(frame)
    return features.plain_codes().transform(coded).select("id", *features.BOOSTED_FEATURES)


# --- models: trained on the hash split of the whole table ------------------------------

_fitted: dict[tuple[str, str, str], models.PipelineModel] = {}


def _model(name: str, train: Callable[..., models.PipelineModel], rows: DataFrame, folder: str) -> models.PipelineModel:
    """Trained once per session and folder, in as many tasks as there are cores."""
    context = rows.sparkSession.sparkContext
    key = (context.applicationId, folder, name)
    if key not in _fitted:
        _fitted[key] = train(rows, partitions=context.defaultParallelism)
    return _fitted[key]


def _forest(spark: SparkSession, folder: str) -> tuple[models.PipelineModel, DataFrame]:
    train, test = splits.hash_split(driver_tables.accidents(spark, folder))
    return _model("forest", models.train_forest, train, folder), features.labelled(test)


def _weighted_forest(spark: SparkSession, folder: str) -> tuple[models.PipelineModel, DataFrame]:
    train, test = splits.hash_split(driver_tables.accidents(spark, folder))
    return _model("weighted", models.train_weighted_forest, train, folder), features.labelled(test)


def _boosted(spark: SparkSession, folder: str) -> tuple[models.PipelineModel, DataFrame]:
    sides = splits.stratified_split(features.labelled(driver_tables.accidents(spark, folder)))
    train, test = splits.split_frames(sides)
    return _model("boosted", models.train_boosted, train.drop("label"), folder), test


def _checks(fitted: Callable, score: Callable) -> Query:
    """Per severity: scored test rows, those whose probabilities do not sum to 1 or whose level is out of range,
    and those that the stored and loaded model scores otherwise."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        model, test = fitted(spark, folder)
        path, once, again = (scratch_dir(spark, name) for name in ("model", "scored", "scored-again"))
        models.save_model(model, path)
        # Stored, so that no plan holds both models.
        score(model, test).select(*test.columns, F.col("predicted_severity").alias("first")).write.parquet(once)
        score(models.load_model(path), spark.read.parquet(once)).write.parquet(again)
        scored = spark.read.parquet(again)
        total = sum((F.col(f"probability_s{c}") for c in (2, 3, 4)), F.col("probability_s1"))
        level = F.col("predicted_severity")
        return scored.groupBy("severity").agg(
            F.count("*").alias("scored"),
            F.count_if(total.isNull() | (F.abs(total - 1) > 1e-9)).alias("off_totals"),
            F.count_if(level.isNull() | ~level.between(1, 4)).alias("off_levels"),
            F.count_if(~level.eqNullSafe(F.col("first"))).alias("changed_by_storage"),
        )

    return run


def _forest_test_scores(spark: SparkSession, folder: str) -> DataFrame:
    return models.score_forest(*_forest(spark, folder))


def _summary(scored: DataFrame) -> DataFrame:
    """Rows, mean confidence and predicted levels per true level."""
    return scored.groupBy("severity", "predicted_severity").agg(
        F.count("*").alias("rows"),
        *[F.round(F.avg(f"probability_s{c}"), 4).alias(f"mean_probability_s{c}") for c in (1, 2, 3, 4)],
    )


def _rf_predictions_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(_forest_test_scores(spark, folder))


def _rf_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.overall_metrics(evaluation.confusion_counts(_forest_test_scores(spark, folder)))


def _confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion_matrix(evaluation.confusion_counts(_forest_test_scores(spark, folder)))


def _feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return models.feature_importance(_forest(spark, folder)[0])


def _importance_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Per model: its features, whether each is one of the published inputs, and whether shares lie between 0 and 1, sum to 1 and come largest first."""
    out = None
    for name, fitted, inputs in (
        ("forest", _forest, features.FOREST_FEATURES),
        ("weighted", _weighted_forest, features.WEIGHTED_FEATURES),
        ("boosted", _boosted, features.BOOSTED_FEATURES),
    ):
        shares = models.feature_importance(fitted(spark, folder)[0])
        place = shares.select("feature", "importance", F.monotonically_increasing_id().alias("place"))
        pairs = F.array_sort(F.collect_list(F.struct("place", "importance")))
        steps = F.aggregate(F.slice(pairs, 2, 99), F.struct(F.element_at(pairs, 1)["importance"].alias("x"), F.lit(True).alias("ok")), lambda a, p: F.struct(p["importance"].alias("x"), (a["ok"] & (p["importance"] <= a["x"])).alias("ok")))
        rows = place.agg(
            F.lit(name).alias("model"),
            F.count_distinct("feature").alias("features"),
            F.count_if(~F.col("feature").isin(*inputs)).alias("unknown"),
            F.count_if(~F.col("importance").between(0, 1)).alias("off_range"),
            F.round(F.sum("importance"), 9).alias("total"),
            steps["ok"].alias("in_order"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _random_split_checks(df: DataFrame) -> DataFrame:
    """Rows on both sides of Spark's random split, in it twice and in neither; and whether the share is near what was asked for."""
    train, test = splits.random_split(df)
    sides = train.select("id").withColumn("train", F.lit(1)).unionByName(test.select("id").withColumn("train", F.lit(0)))
    per_id = sides.groupBy("id").agg(F.count("*").alias("n"), F.sum("train").alias("train"))
    all_ids = df.select("id").join(per_id, "id", "left")
    share = F.sum("train") / F.count("*")
    return all_ids.agg(F.count("*").alias("rows"), F.count_if(F.col("n") > 1).alias("twice"), F.count_if(F.col("n").isNull()).alias("lost"), share.between(0.75, 0.85).alias("near"))


def _random_sample_checks(df: DataFrame) -> DataFrame:
    """Rows of a random sample that the table has not, or has once but the sample twice, and whether it has about the size asked for."""
    drawn = files.random_sample(df, 0.3).groupBy("id").agg(F.count("*").alias("n"))
    found = df.select("id").join(drawn, "id", "full")
    return found.agg(F.count("*").alias("rows"), F.count_if(F.col("n") > 1).alias("twice"), (F.sum("n") / F.count("*")).between(0.25, 0.35).alias("near"))


def _csv_rejects(df: DataFrame) -> DataFrame:
    """Values spoilt on purpose, per column, reason and raw text."""
    spark, path, target = df.sparkSession, scratch_dir(df.sparkSession, "csv-spoilt"), scratch_dir(df.sparkSession, "csv-kept")
    number = F.substring("id", 3, 20).cast("long")
    text = lambda c: F.col(c).cast("string")
    spoilt = df.select(
        "id",
        F.when(number % 7 == 0, "warm").when(number % 11 == 0, "NaN").otherwise(text("temperature_f")).alias("temperature_f"),
        F.when(number % 13 == 0, F.concat(text("severity"), F.lit(".5"))).otherwise(text("severity")).alias("severity"),
        F.when(number % 17 == 0, "maybe").otherwise(text("junction")).alias("junction"),
        F.when(number % 19 == 0, "some day").otherwise(F.date_format("start_time", "yyyy-MM-dd HH:mm:ss")).alias("start_time"),
    )
    files.with_header_names(spoilt).write.option("header", True).csv(path)
    _, rejects = files.read_csv_with_rejects(spark, path, target)
    return rejects.groupBy("column_name", "reason", "raw").agg(F.count("*").alias("rows"), F.min("id").alias("first_id"))


def _csv_rejects_table(df: DataFrame) -> DataFrame:
    """The table that comes with rejected values is the one that is read without them."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "csv")
    files.write_csv(df, path)
    return files.read_csv_with_rejects(spark, path, scratch_dir(spark, "csv-kept"))[0]


def _weighted_forest_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(models.score_weighted_forest(*_weighted_forest(spark, folder)))


def _boosted_predictions_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(models.score_boosted(*_boosted(spark, folder)))


# --- streams: the accident table read as a stream, results read back from the sink --------


def _stream_windows(width: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        events = replay.as_stream(driver_tables.accidents(spark, folder), end_marker={})
        return replay.run_to_table(windows.windowed_severity(alerts.scored(events), width), "windows")

    return run


def _stream_windows_all(spark: SparkSession, folder: str) -> DataFrame:
    """All widths from one query."""
    events = replay.as_stream(driver_tables.accidents(spark, folder), end_marker={})
    return replay.run_to_table(stateful.all_windows(alerts.scored(events)), "all-windows", own_state=True)


def _stream_rolling_exact(spark: SparkSession, folder: str) -> DataFrame:
    events = replay.as_stream(driver_tables.accidents(spark, folder), end_marker={"street": "end of stream"})
    return replay.run_to_table(stateful.rolling_severity_stream(events), "rolling", own_state=True)


def _stream_latest_live(spark: SparkSession, folder: str) -> DataFrame:
    """The latest events as each micro-batch leaves them, the sink being read only at the end."""
    stream = alerts.scored(replay.as_stream(driver_tables.accidents(spark, folder))).select("id", "start_time", "state", "predicted_severity")
    path = scratch_dir(spark, "latest")
    sinks.write_latest(stream, path, alerts.latest_events).awaitTermination()
    return sinks.read_latest(spark, path, alerts.latest_events)


def _stream_scores_by(fitted: Callable) -> Query:
    """Events and those that the stored model could not score, per state, from a stream."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_dir(spark, "model")
        models.save_model(fitted(spark, folder)[0], path)
        stream = alerts.scored(replay.as_stream(driver_tables.accidents(spark, folder)), models.load_model(path))
        stored = replay.run_to_table(stream.select("id", "state", "predicted_severity"), "scores")
        level = F.col("predicted_severity")
        return stored.groupBy("state").agg(F.count("*").alias("events"), F.count_if(level.isNull()).alias("unscored"), F.count_if(~level.between(1, 4)).alias("off_levels"))

    return run


def _stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Worst accidents of the first time range come three ranges late, when their windows are closed."""
    late = F.col("severity") == 4
    events = replay.as_stream(driver_tables.accidents(spark, folder), end_marker={}, late=late)
    return replay.run_to_table(windows.windowed_severity(alerts.scored(events), "15 minutes"), "late")


def _stream_rolling_segments(spark: SparkSession, folder: str) -> DataFrame:
    events = replay.as_stream(driver_tables.accidents(spark, folder), end_marker={"street": "end of stream"})
    return replay.run_to_table(windows.rolling_segments(events), "segments")


def _stream_csv_by_state(spark: SparkSession, folder: str) -> DataFrame:
    events = replay.as_stream(driver_tables.accidents(spark, folder), end_marker={})
    stream = windows.windowed_severity(events, "60 minutes")
    path = scratch_dir(spark, "by-state")
    sinks.write_csv_by_state(stream, path).awaitTermination()
    return sinks.read_csv_by_state(spark, path, stream.schema)


def _stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    stream = alerts.alerts(alerts.scored(replay.as_stream(driver_tables.accidents(spark, folder)))).select(
        "id", "start_time", "state", "severity", "risk", "predicted_severity", "severity_label"
    )
    path = scratch_dir(spark, "alerts")
    sinks.write_alert_files(stream, path).awaitTermination()
    return spark.read.schema(stream.schema).json(path)


def _stored_scores(spark: SparkSession, folder: str) -> DataFrame:
    stream = alerts.scored(replay.as_stream(driver_tables.accidents(spark, folder)))
    return replay.run_to_table(stream.select("id", "start_time", "state", "predicted_severity"), "scores")


def _stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    stream = alerts.scored(replay.as_stream(driver_tables.accidents(spark, folder)))
    return replay.run_to_totals(alerts.running_totals(stream), "totals")


def _stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.latest_events(_stored_scores(spark, folder))


def _stream_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    table = driver_tables.accidents(spark, folder)
    model, _ = _forest(spark, folder)
    stream = alerts.scored(replay.as_stream(table), model)
    return replay.run_to_table(stream.select("id", "start_time", "state", "predicted_severity"), "scores")


def queries() -> dict[str, Query]:
    on_table: dict[str, Callable[[DataFrame], DataFrame]] = {
        # grouped analytics
        "severity_heatmap": lambda df: analytics.severity_heatmap(df, min_count=10),
        "severity_heatmap_dated": lambda df: analytics.severity_heatmap(df, min_count=10, require_time=True),
        "danger_score": analytics.danger_score,
        "weather_risk": analytics.weather_risk,
        "weather_risk_bands": analytics.weather_risk_bands,
        "compound_risk": analytics.compound_risk,
        "compound_risk_dated": lambda df: analytics.compound_risk(df, min_count=50, require_time=True),
        "road_segments": analytics.road_segments,
        "road_segments_labelled": analytics.road_segments_labelled,
        "top_states": analytics.top_states,
        "rush_vs_offpeak": analytics.rush_vs_offpeak,
        "weather_severity": lambda df: analytics.weather_severity(df, min_count=1000),
        "junction_signal": analytics.junction_signal,
        "top_cities_severe": analytics.top_cities_severe,
        "severity_distribution": analytics.severity_distribution,
        "by_hour": analytics.by_hour,
        "top_cities": analytics.top_cities,
        "weather_avg": lambda df: analytics.weather_avg(df, min_count=1000),
        "by_year": lambda df: analytics.by_year(df, last=2024),
        "avg_temp": analytics.avg_temp,
        "common_weather": analytics.common_weather,
        "state_counts": analytics.state_counts,
        "state_profile": analytics.state_profile,
        "weather_by_severity": analytics.weather_by_severity,
        "state_map": analytics.state_map,
        "state_map_worst": analytics.state_map_worst,
        # wide tables
        "heatmap_pivot": reshaped.heatmap_pivot,
        "compound_pivot": reshaped.compound_pivot,
        # profile
        "table_size": profile.table_size,
        "schema_listing": lambda df: profile.schema_listing(df).drop("nullable"),
        "null_profile": profile.null_profile,
        "dense_columns": lambda df: profile.drop_sparse_columns(df, above_pct=25.0),
        "numeric_summary": lambda df: _rounded(profile.numeric_summary(df)),
        "severity_correlation": lambda df: _rounded(profile.severity_correlation(df)),
        # row functions
        "time_features": _time_features,
        "flag_features": _flag_features,
        "road_type_labels": _road_type_labels,
        "risk_score": _risk_score,
        # sources
        "earliest_rows": lambda df: files.earliest_rows(df, 500).select("id", "start_time"),
        "csv_round_trip": _csv_round_trip,
        "csv_quoted_round_trip": _csv_quoted_round_trip,
        "csv_rejects": _csv_rejects,
        "csv_rejects_table": _csv_rejects_table,
        "random_sample": _random_sample_checks,
        "lenient_times": _lenient_times,
        "time_columns": _time_columns,
        "view_sql": _view_sql,
        "preview_rows": lambda df: files.preview(df.orderBy("id"), ("id", *files.PREVIEW_COLUMNS)),
        "parquet_round_trip": _parquet_round_trip,
        "json_round_trip": _json_round_trip,
        # learning
        "forest_features": _forest_features,
        "boosted_features": _boosted_features,
        "impute_means": lambda df: _rounded(features.impute_means(df)),
        "class_weights": _class_weights,
        "stratified_split": _stratified_split,
        "hash_split": _hash_split,
        "random_split": _random_split_checks,
        "category_codes": features.category_codes,
        "rule_unscored": _rule_unscored,
        "rule_confusion": _rule_counts,
        "rule_confusion_matrix": lambda df: evaluation.confusion_matrix(_all_rule_counts(df)),
        "rule_class_report": lambda df: _rounded(evaluation.class_report(_rule_counts(df)).drop("hits")),
        "rule_metrics": lambda df: _rounded(evaluation.overall_metrics(_rule_counts(df))),
        # trends
        "week_over_week": trends.week_over_week,
        "calendar_weeks": trends.calendar_weeks,
        "rolling_15m": trends.rolling_severity,
        "top_rolling_segments": trends.top_rolling_segments,
        "weather_correlation": lambda df: _rounded(trends.weather_correlation(df)),
    }
    on_folder: dict[str, Query] = {
        "rf_predictions_summary": _rf_predictions_summary,
        "rf_metrics": _rf_metrics,
        "confusion_matrix": _confusion_matrix,
        "feature_importance": _feature_importance,
        "importance_checks": _importance_checks,
        "weighted_forest_summary": _weighted_forest_summary,
        "boosted_predictions_summary": _boosted_predictions_summary,
        "boosted_checks": _checks(_boosted, models.score_boosted),
        "forest_checks": _checks(_forest, models.score_forest),
        "weighted_forest_checks": _checks(_weighted_forest, models.score_weighted_forest),
        "stream_windows_5m": _stream_windows("5 minutes"),
        "stream_windows_15m": _stream_windows("15 minutes"),
        "stream_windows_60m": _stream_windows("60 minutes"),
        "stream_windows_all": _stream_windows_all,
        "stream_rolling_exact": _stream_rolling_exact,
        "stream_latest_live": _stream_latest_live,
        "stream_forest_scores": _stream_scores_by(_forest),
        "stream_balanced_scores": _stream_scores_by(_weighted_forest),
        "stream_boosted_scores": _stream_scores_by(_boosted),
        "stream_late_rows": _stream_late_rows,
        "stream_rolling_segments": _stream_rolling_segments,
        "stream_csv_by_state": _stream_csv_by_state,
        "stream_alerts": _stream_alerts,
        "stream_totals": _stream_totals,
        "stream_latest": _stream_latest,
        "stream_model_scores": _stream_model_scores,
    }
    batch = lambda plan: lambda spark, folder: plan(driver_tables.accidents(spark, folder))
    on_texts = llm.queries() if llm else {}
    if corpus_pipeline:
        on_texts["pipeline"] = corpus_pipeline.run
    return {**{name: batch(plan) for name, plan in on_table.items()}, **on_folder, **on_texts}


# --- SQL oracles -----------------------------------------------------------------------

_ACCIDENTS = """
SELECT 'A-' || CAST(e.event_id AS STRING) AS id,
 CASE WHEN e.value < 2 THEN 1 WHEN e.value < 45 THEN 2 WHEN e.value < 150 THEN 3 ELSE 4 END AS severity,
 CASE WHEN e.event_id % 211 = 0 THEN NULL ELSE e.ts END AS start_time,
 CASE WHEN e.event_id % 41 = 0 THEN NULL ELSE 'ST_' || CAST(e.event_id % 23 AS STRING) END AS street,
 c.c_mktsegment AS city, n.n_name AS state,
 CASE WHEN e.event_id % 37 = 0 THEN NULL ELSE e.event_type END AS weather_condition,
 CASE WHEN e.event_id % 53 = 0 THEN NULL ELSE CAST((e.event_id * 7) % 97 - 5 AS DOUBLE) END AS temperature_f,
 CASE WHEN e.event_id % 59 = 0 THEN NULL ELSE CAST(20 + (e.event_id * 13) % 81 AS DOUBLE) END AS humidity_pct,
 CASE WHEN e.event_id % 61 = 0 THEN NULL ELSE greatest(2.5e-1, 1e1 - e.value / 2e1) END AS visibility_mi,
 CASE WHEN e.event_id % 67 = 0 THEN NULL ELSE CAST((e.event_id * 11) % 40 AS DOUBLE) END AS wind_speed_mph,
 CASE WHEN e.event_id % 3 = 0 THEN NULL ELSE CAST(e.event_id % 10 AS DOUBLE) / 1e2 END AS precipitation_in,
 2.9e1 + CAST(e.event_id % 20 AS DOUBLE) / 1e1 AS pressure_in,
 e.value / 1e2 AS distance_mi,
 e.user_id % 3 = 0 AS junction, e.event_id % 5 < 2 AS traffic_signal, e.event_id % 4 = 0 AS crossing,
 CASE WHEN e.event_id % 97 = 0 THEN NULL WHEN hour(e.ts) BETWEEN 6 AND 17 THEN 'Day' ELSE 'Night' END AS sunrise_sunset
FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

_SEVERE = "COUNT(*) FILTER (WHERE severity >= 3)"
_DAY = "dayname(start_time)"
# Hours of the bands and of the rush, as published.
_BAND = (
    "CASE WHEN hour(start_time) BETWEEN 6 AND 9 THEN 'Morning Rush' "
    "WHEN hour(start_time) BETWEEN 10 AND 15 THEN 'Midday' "
    "WHEN hour(start_time) BETWEEN 16 AND 19 THEN 'Evening Rush' ELSE 'Night' END"
)
_PERIOD = (
    "CASE WHEN hour(start_time) BETWEEN 7 AND 9 OR hour(start_time) BETWEEN 16 AND 18 "
    "THEN 'Rush Hour' ELSE 'Off Peak' END"
)
_ROAD = (
    "CASE WHEN junction THEN 'Junction' ELSE 'No Junction' END || ' + ' || "
    "CASE WHEN traffic_signal THEN 'Signal' ELSE 'No Signal' END"
)
_LABEL = "CASE severity WHEN 1 THEN 'Minor' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Serious' WHEN 4 THEN 'Critical' END"
_DESCRIPTION = (
    "CASE severity WHEN 1 THEN 'Short delay, no road closure' "
    "WHEN 2 THEN 'Significant delay, possible lane closure' "
    "WHEN 3 THEN 'Long delay, road partially/fully closed' WHEN 4 THEN 'Major accident, full closure + EMS' END"
)
_BASE_RISK = (
    "(25e-2 * (1e0 - CASE WHEN visibility_mi > 1e1 THEN 1e1 ELSE visibility_mi END / 1e1) "
    "+ 20e-2 * CASE WHEN distance_mi > 1e1 THEN 1e1 ELSE distance_mi END / 1e1 "
    "+ 15e-2 * (humidity_pct / 1e2) + 10e-2 * (wind_speed_mph / 8e1))"
)
_RISK = f"({_BASE_RISK} + 8e-2 * CASE WHEN hour(start_time) IN (7, 8, 17, 18) THEN 1 ELSE 0 END)"


def _level(value: str) -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN NULL "
        f"ELSE CAST(least(4, greatest(1, round_even({value} * 5, 0) + 1)) AS INTEGER) END"
    )


_PREDICTED = f"predicted AS (SELECT *, {_RISK} AS risk, {_level(_RISK)} AS predicted_severity FROM accidents)"
_PAIRS = f"""{_PREDICTED}, pairs AS (
  SELECT severity - 1 AS label, predicted_severity - 1 AS prediction, COUNT(*) AS n
  FROM predicted WHERE predicted_severity IS NOT NULL GROUP BY 1, 2)"""
_REPORT = f"""{_PAIRS}, classes AS (SELECT label AS class FROM pairs UNION SELECT prediction FROM pairs),
 totals AS (
  SELECT class,
   CAST((SELECT COALESCE(SUM(n), 0) FROM pairs WHERE label = class AND prediction = class) AS DOUBLE) AS hits,
   CAST((SELECT COALESCE(SUM(n), 0) FROM pairs WHERE label = class) AS DOUBLE) AS support,
   CAST((SELECT COALESCE(SUM(n), 0) FROM pairs WHERE prediction = class) AS DOUBLE) AS predicted
  FROM classes),
 ratios AS (
  SELECT class, hits, support,
   CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p,
   CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r
  FROM totals),
 report AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM ratios)"""

_COLUMNS = [
    "id", "severity", "start_time", "street", "city", "state", "weather_condition", "temperature_f",
    "humidity_pct", "visibility_mi", "wind_speed_mph", "precipitation_in", "pressure_in", "distance_mi",
    "junction", "traffic_signal", "crossing", "sunrise_sunset",
]
_SUMMARY = ["severity", "distance_mi", "temperature_f", "visibility_mi", "wind_speed_mph", "humidity_pct"]
_CORRELATED = {
    **{c: c for c in ("temperature_f", "humidity_pct", "visibility_mi", "wind_speed_mph", "pressure_in", "distance_mi")},
    "hour": "hour(start_time)",
    "month": "month(start_time)",
}
_IMPUTED = ["temperature_f", "visibility_mi", "wind_speed_mph", "humidity_pct", "precipitation_in", "distance_mi"]


# Rows that come in time where the worst of the first quarter of the time span come after the third.
_IN_TIME = """ AND NOT (severity = 4 AND epoch_us(start_time) < (
    SELECT epoch_us(MIN(start_time)) + (epoch_us(MAX(start_time)) - epoch_us(MIN(start_time))) // 4 FROM predicted))"""


def _windows_sql(minutes: int, with_alerts: bool = True, where: str = "") -> str:
    alert_count = (
        ", CAST(SUM(CASE WHEN predicted_severity >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS alert_count" if with_alerts else ""
    )
    return f"""{_PREDICTED}, timed AS (
      SELECT *, time_bucket(INTERVAL {minutes} MINUTE, start_time) AS w FROM predicted WHERE start_time IS NOT NULL{where})
     SELECT w AS window_start, w + INTERVAL {minutes} MINUTE AS window_end, state, COUNT(*) AS accidents,
      ROUND(AVG(severity), 3) AS avg_severity, {_SEVERE} AS severe_count{alert_count}
     FROM timed GROUP BY w, state"""


_MEASURES = ("temperature_f", "humidity_pct", "visibility_mi", "wind_speed_mph", "pressure_in", "distance_mi")


def unscored(*needed: str) -> str:
    """Events per state and those that lack a needed column."""
    missing = " OR ".join(f"{c} IS NULL" for c in needed)
    return f"SELECT state, COUNT(*) AS events, COUNT(CASE WHEN {missing} THEN 1 END) AS unscored, CAST(0 AS BIGINT) AS off_levels FROM accidents GROUP BY state"


def _ranked(select: str, order: str, limit: int | None = None) -> str:
    return f"{select} ORDER BY {order}" + (f" LIMIT {limit}" if limit else "")


def oracle_sql() -> dict[str, str]:
    heatmap = (
        f"SELECT CAST(hour(start_time) AS INTEGER) AS hour_of_day, {_DAY} AS day_of_week, COUNT(*) AS total_accidents, "
        "ROUND(AVG(severity), 3) AS avg_severity FROM accidents {where} GROUP BY 1, 2 HAVING COUNT(*) > 10"
    )
    heatmap_order = "avg_severity DESC NULLS LAST, hour_of_day NULLS LAST, day_of_week NULLS LAST"
    compound = (
        f"SELECT junction, traffic_signal, {_BAND} AS time_of_day, COUNT(*) AS accidents, "
        f"ROUND(AVG(severity), 3) AS avg_severity, ROUND({_SEVERE} * 1e2 / COUNT(*), 2) AS high_severity_pct "
        "FROM accidents {where} GROUP BY 1, 2, 3 HAVING COUNT(*) > {n}"
    )
    compound_order = "avg_severity DESC NULLS LAST, junction NULLS LAST, traffic_signal NULLS LAST, time_of_day"
    segments = (
        "SELECT street, city, state, COUNT(*) AS total_accidents, ROUND(AVG(severity), 3) AS avg_severity, "
        f"MAX(severity) AS worst_severity, {_SEVERE} AS serious_accidents FROM accidents "
        "WHERE street IS NOT NULL GROUP BY street, city, state HAVING COUNT(*) > 5"
    )
    segments = _ranked(
        segments, "serious_accidents DESC, avg_severity DESC, street, city NULLS LAST, state NULLS LAST", 10
    )
    weather = (
        f"SELECT weather_condition, COUNT(*) AS total_accidents, {_SEVERE} AS high_severity_count, "
        f"ROUND({_SEVERE} * 1e2 / COUNT(*), 2) AS risk_index_pct, ROUND(AVG(severity), 3) AS avg_severity "
        "FROM accidents WHERE weather_condition IS NOT NULL GROUP BY weather_condition HAVING COUNT(*) > 1000"
    )
    weather_order = "risk_index_pct DESC, weather_condition"
    rolling = f"""per_row AS (
      SELECT street, city, state, severity, CAST(floor(epoch(start_time)) AS BIGINT) AS second
      FROM accidents WHERE start_time IS NOT NULL AND street IS NOT NULL),
     rolled AS (
      SELECT DISTINCT street, city, state, second, COUNT(severity) OVER w AS accidents,
       CAST(SUM(CASE WHEN severity >= 3 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS severe_accidents,
       AVG(severity) OVER w AS avg_severity
      FROM per_row
      WINDOW w AS (PARTITION BY street, city, state ORDER BY second RANGE BETWEEN 899 PRECEDING AND CURRENT ROW))"""
    pivot_hours = ", ".join(
        f"ROUND(AVG(CASE WHEN hour(start_time) = {h} THEN severity END), 3) AS h{h:02d}" for h in range(24)
    )
    pivot_bands = ", ".join(
        f"MAX(CASE WHEN b = '{band}' THEN avg_severity END) AS {name}"
        for band, name in [
            ("Evening Rush", "evening_rush"),
            ("Midday", "midday"),
            ("Morning Rush", "morning_rush"),
            ("Night", "night"),
        ]
    )
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
        f"ROUND(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) * 1e2, 2) AS null_pct FROM accidents"
        for c in _COLUMNS
    )
    summary = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, "
        f"ROUND(STDDEV_SAMP({c}), 6) AS stddev, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, "
        f"ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max FROM accidents"
        for c in _SUMMARY
    )
    correlation = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, CASE WHEN STDDEV_POP({x}) > 0 THEN ROUND(corr({x}, severity), 6) END "
        "AS correlation FROM accidents"
        for name, x in _CORRELATED.items()
    )
    means = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, ROUND(AVG({c}), 6) AS mean FROM accidents" for c in _IMPUTED
    )
    weighted_rows = (
        "weighted AS (SELECT severity - 1 AS label FROM accidents WHERE temperature_f IS NOT NULL AND humidity_pct IS NOT NULL "
        "AND visibility_mi IS NOT NULL AND wind_speed_mph IS NOT NULL AND pressure_in IS NOT NULL AND distance_mi IS NOT NULL)"
    )
    boosted_rows = (
        "frame AS (SELECT * FROM accidents WHERE temperature_f IS NOT NULL AND humidity_pct IS NOT NULL AND visibility_mi IS NOT NULL "
        "AND wind_speed_mph IS NOT NULL AND pressure_in IS NOT NULL AND distance_mi IS NOT NULL AND start_time IS NOT NULL)"
    )
    checks = lambda rows: (
        "SELECT severity, COUNT(*) AS scored, CAST(0 AS BIGINT) AS off_totals, CAST(0 AS BIGINT) AS off_levels, "
        f"CAST(0 AS BIGINT) AS changed_by_storage FROM ({rows}) GROUP BY severity"
    )
    categories = ["weather_condition", "state", "sunrise_sunset"]
    codes = lambda as_type: ", ".join(
        f"CAST(DENSE_RANK() OVER (ORDER BY COALESCE({c}, 'nan')) - 1 AS {as_type}) AS {c}_code" for c in categories
    )
    hits = lambda c: f"CAST(SUM(CASE WHEN p.prediction = {c} THEN n ELSE 0 END) AS BIGINT) AS predicted_{c}"
    band = lambda value, high, medium, op: (
        f"CASE WHEN {value} {op} {high} THEN 'high' WHEN {value} {op} {medium} THEN 'medium' ELSE 'low' END"
    )

    bodies = {
        "severity_heatmap": _ranked(heatmap.format(where=""), heatmap_order, 10),
        "severity_heatmap_dated": _ranked(heatmap.format(where="WHERE start_time IS NOT NULL"), heatmap_order, 10),
        "danger_score": _ranked(
            "SELECT state, COUNT(*) AS total_accidents, ROUND(AVG(severity), 3) AS avg_severity, "
            f"{_SEVERE} AS high_severity_count, "
            f"ROUND(AVG(severity) * 4e-1 + CAST({_SEVERE} AS DOUBLE) / COUNT(*) * 6e-1, 4) AS danger_score "
            "FROM accidents GROUP BY state HAVING COUNT(*) > 500",
            "danger_score DESC, state NULLS LAST",
            10,
        ),
        "weather_risk": _ranked(weather, weather_order, 10),
        "weather_risk_bands": (
            f"SELECT weather_condition, total_accidents, risk_index_pct, avg_severity, "
            f"{band('risk_index_pct', 48, 43, '>=')} AS risk_band FROM ({_ranked(weather, weather_order, 8)})"
        ),
        "compound_risk": _ranked(compound.format(where="", n=200), compound_order, 12),
        "compound_risk_dated": _ranked(
            compound.format(where="WHERE start_time IS NOT NULL", n=50), compound_order, 12
        ),
        "road_segments": segments,
        "road_segments_labelled": (
            "SELECT street || ', ' || city AS road_label, total_accidents, avg_severity, serious_accidents "
            f"FROM ({segments})"
        ),
        "top_states": _ranked(
            "SELECT state, COUNT(*) AS total_accidents, ROUND(AVG(severity), 2) AS avg_severity FROM accidents GROUP BY state",
            "total_accidents DESC, state NULLS LAST",
            10,
        ),
        "rush_vs_offpeak": (
            f"SELECT {_PERIOD} AS time_period, COUNT(*) AS accident_count, ROUND(AVG(severity), 3) AS avg_severity "
            "FROM accidents GROUP BY 1"
        ),
        "weather_severity": _ranked(
            "SELECT weather_condition, COUNT(*) AS total, ROUND(AVG(severity), 2) AS avg_severity, "
            f"{_SEVERE} AS high_severity_count FROM accidents WHERE weather_condition IS NOT NULL "
            "GROUP BY weather_condition HAVING COUNT(*) > 1000",
            "avg_severity DESC, weather_condition",
            8,
        ),
        "junction_signal": (
            "SELECT junction, traffic_signal, COUNT(*) AS accidents, ROUND(AVG(severity), 3) AS avg_severity "
            "FROM accidents GROUP BY 1, 2"
        ),
        "top_cities_severe": _ranked(
            "SELECT city, state, COUNT(*) AS high_severity_accidents FROM accidents WHERE severity >= 3 GROUP BY city, state",
            "high_severity_accidents DESC, city NULLS LAST, state NULLS LAST",
            10,
        ),
        "severity_distribution": (
            "SELECT severity, COUNT(*) AS count, COUNT(*) * 1e2 / (SELECT COUNT(*) FROM accidents) AS pct, "
            f"{_LABEL} AS label, {_DESCRIPTION} AS description FROM accidents GROUP BY severity"
        ),
        "by_hour": "SELECT CAST(hour(start_time) AS INTEGER) AS hour, COUNT(*) AS count FROM accidents GROUP BY 1",
        "top_cities": _ranked(
            "SELECT city, state, COUNT(*) AS count, city || ', ' || state AS label FROM accidents GROUP BY city, state",
            "count DESC, city NULLS LAST, state NULLS LAST",
            10,
        ),
        "weather_avg": _ranked(
            "SELECT weather_condition, AVG(severity) AS avg_severity, COUNT(*) AS total, "
            f"{band('AVG(severity)', 2.5, 2.2, '>=')} AS severity_band "
            "FROM accidents GROUP BY weather_condition HAVING COUNT(*) > 1000",
            "avg_severity DESC, weather_condition NULLS LAST",
            12,
        ),
        "by_year": (
            "SELECT CAST(year(start_time) AS INTEGER) AS year, COUNT(*) AS count FROM accidents "
            "WHERE year(start_time) BETWEEN 2016 AND 2024 GROUP BY 1"
        ),
        "avg_temp": "SELECT severity, ROUND(AVG(temperature_f), 2) AS avg_temp FROM accidents GROUP BY severity",
        "common_weather": _ranked(
            "SELECT weather_condition, COUNT(*) AS count FROM accidents GROUP BY 1",
            "count DESC, weather_condition NULLS LAST",
            10,
        ),
        "state_counts": _ranked(
            "SELECT state, COUNT(*) AS count FROM accidents GROUP BY 1", "count DESC, state NULLS LAST", 10
        ),
        "state_profile": _ranked(
            "SELECT state, COUNT(severity) AS total, AVG(severity) AS avg FROM accidents WHERE state IS NOT NULL GROUP BY 1",
            "total DESC, state",
            15,
        ),
        "weather_by_severity": (
            "SELECT weather_condition, severity, COUNT(*) AS count FROM accidents WHERE weather_condition IN ("
            "SELECT weather_condition FROM accidents WHERE weather_condition IS NOT NULL GROUP BY 1 "
            "ORDER BY COUNT(*) DESC, weather_condition LIMIT 8) GROUP BY 1, 2"
        ),
        "state_map": (
            "SELECT state, COUNT(*) AS total_accidents, ROUND(AVG(severity), 3) AS avg_severity, "
            "COUNT(*) * 1e2 / (SELECT COUNT(*) FROM accidents WHERE state IS NOT NULL) AS pct "
            "FROM accidents WHERE state IS NOT NULL GROUP BY state"
        ),
        "state_map_worst": (
            f"SELECT state, avg_severity, {band('avg_severity', 2.4, 2.3, '>')} AS severity_band FROM ("
            "SELECT state, ROUND(AVG(severity), 3) AS avg_severity FROM accidents WHERE state IS NOT NULL GROUP BY state "
            "ORDER BY avg_severity DESC, state LIMIT 5)"
        ),
        "heatmap_pivot": (
            f"SELECT CAST(isodow(start_time) - 1 AS INTEGER) AS day_order, LEFT({_DAY}, 3) AS day_of_week, {pivot_hours} "
            "FROM accidents WHERE start_time IS NOT NULL GROUP BY 1, 2"
        ),
        "compound_pivot": (
            f"SELECT road_type, {pivot_bands} FROM (SELECT {_ROAD} AS road_type, {_BAND} AS b, "
            "ROUND(AVG(severity), 3) AS avg_severity FROM accidents GROUP BY 1, 2 HAVING COUNT(*) > 200) GROUP BY road_type"
        ),
        "table_size": f"SELECT COUNT(*) AS row_count, {len(_COLUMNS)} AS column_count FROM accidents",
        "null_profile": f"SELECT * FROM ({nulls}) WHERE null_pct > 0",
        "numeric_summary": summary,
        "severity_correlation": correlation,
        "time_features": (
            "SELECT id, CAST(hour(start_time) AS INTEGER) AS hour_of_day, "
            "CAST(dayofweek(start_time) + 1 AS INTEGER) AS day_from_sunday, "
            "CAST(isodow(start_time) - 1 AS INTEGER) AS day_from_monday, "
            "CAST(dayofweek(start_time) AS INTEGER) AS day_from_sunday_zero, "
            "CAST(month(start_time) AS INTEGER) AS month, CAST(year(start_time) AS INTEGER) AS year, "
            f"{_DAY} AS day_name, LEFT({_DAY}, 3) AS short_day_name, {_BAND} AS time_of_day, {_PERIOD} AS time_period "
            "FROM accidents"
        ),
        "flag_features": (
            "SELECT id, CASE WHEN severity >= 3 THEN 1 ELSE 0 END AS is_severe, "
            "CASE WHEN sunrise_sunset = 'Night' THEN 1 ELSE 0 END AS is_night, "
            "CASE WHEN junction THEN 1 ELSE 0 END AS junction_int, "
            "CASE WHEN traffic_signal THEN 1 ELSE 0 END AS traffic_signal_int, "
            "CASE WHEN crossing THEN 1 ELSE 0 END AS crossing_int, 0 AS weather_as_flag FROM accidents"
        ),
        "road_type_labels": (
            f"SELECT id, {_ROAD} AS road_type, street || ', ' || city AS road_label, {_LABEL} AS severity_label, "
            f"{_DESCRIPTION} AS severity_description, "
            "CASE severity WHEN 1 THEN '2–5 min' WHEN 2 THEN '10–30 min' WHEN 3 THEN '45min–2hr' "
            "WHEN 4 THEN '3–6+ hrs' END AS severity_duration, "
            "CASE severity WHEN 1 THEN 'None needed' WHEN 2 THEN 'Police + Tow Truck' "
            "WHEN 3 THEN 'Police + Ambulance + Tow' WHEN 4 THEN 'Full Emergency Response' END AS severity_response "
            "FROM accidents"
        ),
        "risk_score": f""", scores AS (SELECT id, {_BASE_RISK} AS base_risk, {_RISK} AS risk FROM accidents),
          parts AS (SELECT *, CASE WHEN 1e-1 - risk * 5e-2 < 0 THEN 0e0 ELSE 1e-1 - risk * 5e-2 END AS p1,
            5e-1 - risk * 2e-1 AS p2, 3e-1 + risk * 1e-1 AS p3, risk * 1e-1 + 1e-1 AS p4 FROM scores)
         SELECT id, base_risk, risk, {_level('risk')} AS predicted_severity,
          p1 / (p1 + p2 + p3 + p4) AS probability_s1, p2 / (p1 + p2 + p3 + p4) AS probability_s2,
          p3 / (p1 + p2 + p3 + p4) AS probability_s3, p4 / (p1 + p2 + p3 + p4) AS probability_s4,
          {_level('base_risk')} AS base_severity FROM parts""",
        "earliest_rows": "SELECT id, start_time FROM accidents ORDER BY start_time NULLS LAST, id LIMIT 500",
        "csv_round_trip": "SELECT * FROM accidents",
        "csv_quoted_round_trip": (
            "SELECT id, 'at \"' || state || '\", lane ' || city AS street, severity FROM accidents"
        ),
        "lenient_times": (
            "SELECT id, CASE WHEN hour(start_time) % 7 <> 0 THEN date_trunc('second', start_time) END AS start_time FROM accidents"
        ),
        "time_columns": (
            "SELECT id, CAST(hour(start_time) AS INTEGER) AS hour, CAST(month(start_time) AS INTEGER) AS month, "
            "CAST(isodow(start_time) - 1 AS INTEGER) AS day_of_week, CAST(year(start_time) AS INTEGER) AS year FROM accidents"
        ),
        "view_sql": "SELECT state, COUNT(*) AS accidents, MAX(temperature_f) AS warmest FROM accidents GROUP BY state",
        "preview_rows": (
            "SELECT id, severity, state, temperature_f, humidity_pct, weather_condition, distance_mi FROM accidents ORDER BY id LIMIT 8"
        ),
        "dense_columns": "SELECT * EXCLUDE (precipitation_in) FROM accidents",
        "rule_unscored": (
            f", {_PREDICTED} SELECT severity, COUNT(*) AS rows, "
            "COUNT(*) FILTER (WHERE predicted_severity IS NULL) AS unscored FROM predicted GROUP BY severity"
        ),
        "boosted_checks": checks(
            "SELECT severity FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY severity ORDER BY md5(id || '#42')) "
            "> floor(COUNT(*) OVER (PARTITION BY severity) * 8e-1) AS test FROM accidents) WHERE test AND start_time IS NOT NULL "
            "AND temperature_f IS NOT NULL AND humidity_pct IS NOT NULL AND visibility_mi IS NOT NULL "
            "AND wind_speed_mph IS NOT NULL AND pressure_in IS NOT NULL AND distance_mi IS NOT NULL"
        ),
        "forest_checks": checks(
            "SELECT severity FROM accidents WHERE LEFT(md5(id || '#42'), 8) >= 'cccccccc' AND start_time IS NOT NULL"
        ),
        "weighted_forest_checks": checks(
            "SELECT severity FROM accidents WHERE LEFT(md5(id || '#42'), 8) >= 'cccccccc' AND temperature_f IS NOT NULL "
            "AND humidity_pct IS NOT NULL AND visibility_mi IS NOT NULL AND wind_speed_mph IS NOT NULL "
            "AND pressure_in IS NOT NULL AND distance_mi IS NOT NULL"
        ),
        "parquet_round_trip": "SELECT *, CAST(year(start_time) AS INTEGER) AS year FROM accidents",
        "json_round_trip": "SELECT *, CAST(NULL AS VARCHAR) AS _malformed FROM accidents",
        "forest_features": (
            f"SELECT id, {', '.join(_IMPUTED)}, CAST(hour(start_time) AS INTEGER) AS hour_of_day, "
            "CAST(dayofweek(start_time) + 1 AS INTEGER) AS day_of_week, "
            "CASE WHEN sunrise_sunset = 'Night' THEN 1 ELSE 0 END AS is_night, "
            "CASE WHEN junction THEN 1 ELSE 0 END AS junction_int, "
            "CASE WHEN traffic_signal THEN 1 ELSE 0 END AS traffic_signal_int, "
            "CAST(severity - 1 AS DOUBLE) AS label FROM accidents WHERE severity IS NOT NULL"
        ),
        "boosted_features": (
            f", {boosted_rows} SELECT id, temperature_f, humidity_pct, visibility_mi, wind_speed_mph, pressure_in, distance_mi, "
            "CAST(hour(start_time) AS INTEGER) AS hour, CAST(isodow(start_time) - 1 AS INTEGER) AS day_of_week, "
            "CAST(month(start_time) AS INTEGER) AS month, CASE WHEN junction THEN 1 ELSE 0 END AS junction, "
            "CASE WHEN crossing THEN 1 ELSE 0 END AS crossing, CASE WHEN traffic_signal THEN 1 ELSE 0 END AS traffic_signal, "
            f"{codes('DOUBLE')} FROM frame"
        ),
        "impute_means": means,
        "class_weights": (
            f", {weighted_rows} SELECT label, COUNT(*) AS rows, CAST((SELECT COUNT(*) FROM weighted) AS DOUBLE) / "
            "((SELECT COUNT(DISTINCT label) FROM weighted) * COUNT(*)) AS weight FROM weighted GROUP BY label"
        ),
        "stratified_split": (
            "SELECT id, severity, CASE WHEN ROW_NUMBER() OVER (PARTITION BY severity ORDER BY md5(id || '#42')) "
            "<= floor(COUNT(*) OVER (PARTITION BY severity) * 8e-1) THEN 'train' ELSE 'test' END AS split FROM accidents"
        ),
        "hash_split": (
            "SELECT id, CASE WHEN LEFT(md5(id || '#42'), 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split FROM accidents"
        ),
        "category_codes": f"SELECT id, {codes('INTEGER')} FROM accidents",
        "rule_confusion": f", {_PAIRS} SELECT label, prediction, n AS count FROM pairs",
        "rule_confusion_matrix": (
            f", {_PREDICTED}, pairs AS (SELECT severity - 1 AS label, predicted_severity - 1 AS prediction, COUNT(*) AS n "
            f"FROM predicted GROUP BY 1, 2) SELECT l.label, {', '.join(hits(c) for c in range(4))}, "
            "CAST(COALESCE(SUM(CASE WHEN p.prediction IS NULL THEN p.n END), 0) AS BIGINT) AS predicted_other "
            "FROM (VALUES (0), (1), (2), (3)) l(label) LEFT JOIN pairs p ON p.label = l.label GROUP BY l.label"
        ),
        "rule_class_report": (
            f", {_REPORT} SELECT class, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, "
            "CAST(support AS BIGINT) AS support FROM report"
        ),
        "rule_metrics": (
            f", {_REPORT} SELECT ROUND(SUM(hits) / SUM(support), 6) AS accuracy, "
            "ROUND(SUM(f * support) / SUM(support), 6) AS f1, "
            "ROUND(SUM(p * support) / SUM(support), 6) AS weighted_precision, "
            "ROUND(SUM(r * support) / SUM(support), 6) AS weighted_recall FROM report"
        ),
        "week_over_week": """, weekly AS (
           SELECT state, CAST(date_trunc('week', start_time) AS DATE) AS week, COUNT(*) AS accidents
           FROM accidents WHERE start_time IS NOT NULL AND state IS NOT NULL GROUP BY 1, 2),
          lagged AS (SELECT *, LAG(accidents) OVER (PARTITION BY state ORDER BY week) AS previous FROM weekly)
         SELECT state, week, accidents, previous,
          ROUND(CAST(accidents - previous AS DOUBLE) * 1e2 / previous, 2) AS growth_pct FROM lagged""",
        "calendar_weeks": """, weekly AS (
           SELECT state, CAST(date_trunc('week', start_time) AS DATE) AS week, COUNT(*) AS accidents
           FROM accidents WHERE start_time IS NOT NULL AND state IS NOT NULL GROUP BY 1, 2),
          spine AS (
           SELECT state, CAST(UNNEST(generate_series(CAST(MIN(week) AS TIMESTAMP), CAST(MAX(week) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week
           FROM weekly GROUP BY state),
          dense AS (SELECT s.state, s.week, COALESCE(w.accidents, 0) AS accidents FROM spine s LEFT JOIN weekly w ON s.state = w.state AND s.week = w.week),
          lagged AS (SELECT *, LAG(accidents) OVER (PARTITION BY state ORDER BY week) AS previous FROM dense)
         SELECT state, week, accidents, previous,
          ROUND(CAST(accidents - previous AS DOUBLE) * 1e2 / NULLIF(previous, 0), 2) AS growth_pct FROM lagged""",
        "rolling_15m": f", {rolling} SELECT * FROM rolled",
        "top_rolling_segments": (
            f", {rolling} SELECT street, city, state, MAX(severe_accidents) AS peak_severe, "
            "MAX(accidents) AS peak_accidents, ROUND(MAX(avg_severity), 3) AS peak_avg_severity FROM rolled "
            "GROUP BY street, city, state ORDER BY peak_severe DESC, peak_avg_severity DESC NULLS LAST, "
            "peak_accidents DESC, street, city NULLS LAST, state NULLS LAST LIMIT 10"
        ),
        "weather_correlation": """, known AS (
           SELECT weather_condition, CASE WHEN severity >= 3 THEN 1 ELSE 0 END AS severe
           FROM accidents WHERE weather_condition IS NOT NULL AND severity IS NOT NULL),
          conditions AS (SELECT DISTINCT weather_condition AS c FROM known)
         SELECT c AS weather_condition, COUNT(CASE WHEN weather_condition = c THEN 1 END) AS accidents,
          CAST(SUM(CASE WHEN weather_condition = c THEN severe ELSE 0 END) AS BIGINT) AS severe_accidents,
          ROUND(corr(CASE WHEN weather_condition = c THEN 1 ELSE 0 END, severe), 6) AS correlation
         FROM conditions CROSS JOIN known GROUP BY c""",
        "stream_windows_5m": f", {_windows_sql(5)}",
        "stream_windows_15m": f", {_windows_sql(15)}",
        "stream_windows_60m": f", {_windows_sql(60)}",
        "stream_late_rows": f", {_windows_sql(15, where=_IN_TIME)}",
        "stream_windows_all": f""", {_PREDICTED}, timed AS (SELECT *, UNNEST([5, 15, 60]) AS m FROM predicted WHERE start_time IS NOT NULL),
          bucketed AS (
           SELECT *, CASE m WHEN 5 THEN time_bucket(INTERVAL 5 MINUTE, start_time) WHEN 15 THEN time_bucket(INTERVAL 15 MINUTE, start_time)
            ELSE time_bucket(INTERVAL 60 MINUTE, start_time) END AS w FROM timed)
         SELECT CAST(m AS INTEGER) AS width_minutes, w AS window_start, w + to_minutes(m) AS window_end, state, COUNT(*) AS accidents,
          ROUND(AVG(severity), 3) AS avg_severity, {_SEVERE} AS severe_count,
          CAST(SUM(CASE WHEN predicted_severity >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS alert_count
         FROM bucketed GROUP BY m, w, state""",
        "stream_forest_scores": unscored("start_time"),
        "stream_balanced_scores": unscored(*_MEASURES, "junction", "crossing", "traffic_signal"),
        "stream_boosted_scores": unscored("start_time", *_MEASURES, "junction", "crossing", "traffic_signal"),
        "random_split": "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS twice, CAST(0 AS BIGINT) AS lost, TRUE AS near FROM accidents",
        "random_sample": "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS twice, TRUE AS near FROM accidents",
        "schema_listing": " UNION ALL ".join(
            f"(SELECT {i} AS position, '{c}' AS column_name, CASE ANY_VALUE(typeof({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
            f"WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type FROM accidents)"
            for i, c in enumerate(_COLUMNS)
        ),
        "importance_checks": (
            "SELECT model, CAST(features AS BIGINT) AS features, CAST(0 AS BIGINT) AS unknown, CAST(0 AS BIGINT) AS off_range, "
            "CAST(1 AS DOUBLE) AS total, TRUE AS in_order FROM (VALUES ('forest', 11), ('weighted', 9), ('boosted', 15)) AS m(model, features)"
        ),
        "csv_rejects": """, numbered AS (SELECT *, CAST(substr(id, 3) AS BIGINT) AS n FROM accidents),
          rejected AS (
           SELECT id, 'temperature_f' AS column_name, 'no number' AS reason, 'warm' AS raw FROM numbered WHERE n % 7 = 0
           UNION ALL SELECT id, 'severity', 'no integer', severity || '.5' FROM numbered WHERE n % 13 = 0
           UNION ALL SELECT id, 'junction', 'no truth value', 'maybe' FROM numbered WHERE n % 17 = 0
           UNION ALL SELECT id, 'start_time', 'no time', 'some day' FROM numbered WHERE n % 19 = 0)
         SELECT column_name, reason, raw, COUNT(*) AS rows, MIN(id) AS first_id FROM rejected GROUP BY column_name, reason, raw""",
        "stream_rolling_segments": f""", starts AS (
           SELECT *, UNNEST([0, 5, 10]) AS back FROM accidents WHERE start_time IS NOT NULL AND street IS NOT NULL),
          windows AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, start_time) - to_minutes(back) AS w FROM starts)
         SELECT w AS window_start, w + INTERVAL 15 MINUTE AS window_end, street, city, state, COUNT(*) AS accidents,
          ROUND(AVG(severity), 3) AS avg_severity, {_SEVERE} AS severe_count
         FROM windows GROUP BY w, street, city, state""",
        "stream_csv_by_state": f", {_windows_sql(60, with_alerts=False)}",
        "stream_alerts": (
            f", {_PREDICTED} SELECT id, start_time, state, severity, risk, predicted_severity, "
            "CASE predicted_severity WHEN 3 THEN 'Serious' WHEN 4 THEN 'Critical' END AS severity_label "
            "FROM predicted WHERE predicted_severity >= 3"
        ),
        "stream_totals": (
            f", {_PREDICTED} SELECT COUNT(*) AS records, COUNT(CASE WHEN predicted_severity >= 3 THEN 1 END) AS alerts, "
            "COUNT(CASE WHEN predicted_severity IS NULL THEN 1 END) AS unscored FROM predicted"
        ),
        "stream_latest": (
            f", {_PREDICTED} SELECT id, start_time, state, predicted_severity FROM predicted "
            "ORDER BY start_time DESC NULLS LAST, id DESC LIMIT 12"
        ),
    }
    bodies["stream_rolling_exact"], bodies["stream_latest_live"], bodies["csv_rejects_table"] = bodies["rolling_15m"], bodies["stream_latest"], bodies["csv_round_trip"]
    on_texts = llm.oracles() if llm else {}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        on_texts["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: f"WITH accidents AS ({_ACCIDENTS}) {body}" for name, body in bodies.items()} | on_texts
