"""Splits, encoders, models and metrics."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from kerbstat.operators import evaluation, features, models, rules, splits
from kerbstat.schema import ACCIDENTS


@pytest.fixture(scope="module")
def sides(accidents):
    return splits.hash_split(accidents)


@pytest.fixture(scope="module")
def forest(sides):
    return models.train_forest(sides[0], trees=10, depth=6)


@pytest.fixture(scope="module")
def boosted(sides):
    return models.train_boosted(sides[0], rounds=2, depth=3)


def outcome(scored):
    return sorted((r.id, r.predicted_severity, round(r.probability_s2, 9)) for r in scored.collect())


def test_stratified_split_is_exact_per_class(accidents):
    for fraction in (0.8, 0.5, 0.0, 1.0):
        labelled = features.labelled(accidents)
        split = splits.stratified_split(labelled, fraction)
        counts = split.groupBy("label").agg(
            F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("train")
        ).collect()
        assert [r.train for r in counts] == [math.floor(r.n * fraction) for r in counts]


@pytest.mark.parametrize("digits", [(1,), (2,), (1, 2, 3), (6,)])
def test_stratified_split_does_not_depend_on_prefix_or_layout(accidents, digits):
    labelled = features.labelled(accidents)
    expected = sorted(map(tuple, splits.stratified_split(labelled).select("id", "split").collect()))
    other = splits.stratified_split(labelled.repartition(7, "state"), prefix_digits=digits)
    assert sorted(map(tuple, other.select("id", "split").collect())) == expected


def test_stratified_split_of_tiny_classes(make):
    df = features.labelled(make([{"id": str(i), "severity": s} for i, s in enumerate([1, 2, 2, 3, 3, 3, 3, 3])]))
    rows = splits.stratified_split(df).groupBy("severity").agg(F.count_if(F.col("split") == "train").alias("t"))
    assert {r.severity: r.t for r in rows.collect()} == {1: 0, 2: 1, 3: 4}


def test_hash_split_is_disjoint_complete_and_near_its_fraction(accidents, sides):
    train, test = (set(r.id for r in s.select("id").collect()) for s in sides)
    assert not train & test and len(train | test) == accidents.count()
    assert abs(len(train) / 10000 - 0.8) < 0.02


def test_hash_split_of_everything(small):
    train, test = splits.hash_split(small, 1.0)
    assert (train.count(), test.count()) == (small.count(), 0)


def test_class_absent_from_training_has_probability_zero(make):
    number = {f.name: 1.0 for f in ACCIDENTS if f.dataType.simpleString() == "double"}
    rows = [{**number, "id": str(i), "severity": 1 + i % 2, "humidity_pct": float(i % 2),
             "start_time": dt.datetime(2024, 1, 1), "junction": True, "crossing": True,
             "traffic_signal": False} for i in range(40)]
    df = make(rows)
    for score, model in [(models.score_forest, models.train_forest(df, trees=3, depth=2)),
                         (models.score_boosted, models.train_boosted(df, rounds=2, depth=2))]:
        scored = score(model, df).collect()
        assert {r.probability_s4 for r in scored} == {0.0}
        assert sum(r.severity == r.predicted_severity for r in scored) > 30


def test_random_split_covers_all_rows(small):
    train, test = splits.random_split(small)
    assert train.count() + test.count() == small.count()


def test_imputer_learns_from_train_only(sides):
    train = sides[0]
    means = {r.column_name: r.mean for r in features.impute_means(train).collect()}
    assert means["humidity_pct"] == pytest.approx(train.agg(F.avg("humidity_pct")).first()[0])


def test_imputer_fills_null_and_nan(make):
    df = features.labelled(make([{"id": str(i), "severity": 2, **{c: v for c in features.IMPUTED}}
                                 for i, v in enumerate([1.0, 3.0, None, float("nan")])]))
    filled = features.mean_imputer().fit(df).transform(df)
    assert [r.humidity_pct for r in filled.orderBy("id").collect()] == [1.0, 3.0, 2.0, 2.0]


def test_class_weights_balance_the_classes(accidents):
    frame = features.labelled(features.weighted_frame(accidents))
    weighted = features.with_class_weight(frame, features.class_weights(frame))
    sums = [r.s for r in weighted.groupBy("label").agg(F.sum("weight").alias("s")).collect()]
    assert sums == pytest.approx([weighted.count() / 4] * 4)


def test_unseen_category_gets_the_next_code(make):
    seen = make([{"id": "1", "weather_condition": "Rain", "state": "B", "sunrise_sunset": "Day"},
                 {"id": "2", "weather_condition": None, "state": "A", "sunrise_sunset": "Night"}])
    codes = {r.id: r.weather_condition_code for r in features.category_codes(seen).collect()}
    assert codes == {"1": 0, "2": 1}  # "Rain" sorts before "nan"
    model = features.category_encoder().fit(seen.fillna("nan"))
    fresh = make([{"id": "3", "weather_condition": "Hail", "state": "A", "sunrise_sunset": "Day"}])
    assert model.transform(fresh).first().weather_condition_index == 2.0


def test_forest_is_deterministic_and_survives_storage(sides, forest, tmp_path):
    again = models.train_forest(sides[0], trees=10, depth=6)
    path = str(tmp_path / "forest")
    assert models.load_model(path) is None
    models.save_model(forest, path)
    models.save_model(forest, path)  # overwrites
    expected = outcome(models.score_forest(forest, sides[1]))
    assert outcome(models.score_forest(again, sides[1])) == expected
    assert outcome(models.score_forest(models.load_model(path), sides[1])) == expected


def test_forest_scores_keep_the_table(sides, forest):
    test = sides[1]
    scored = models.score_forest(forest, test)
    assert scored.columns[: len(test.columns)] == test.columns
    joined = scored.join(test.select("id", F.col("humidity_pct").alias("own")), "id")
    assert joined.filter(~F.col("own").eqNullSafe(F.col("humidity_pct"))).count() == 0
    # only rows without a time lack a feature
    assert scored.count() == test.filter("start_time IS NOT NULL").count()
    total = sum(F.col(f"probability_s{c}") for c in (2, 3, 4)) + F.col("probability_s1")
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    assert scored.filter("predicted_severity != prediction + 1 OR predicted_severity NOT BETWEEN 1 AND 4").count() == 0


def test_forest_prediction_equals_the_library_s(sides, forest):
    frame = features.forest_frame(sides[1])
    theirs = sorted((r.id, r.prediction) for r in forest.transform(frame).select("id", "prediction").collect())
    ours = sorted((r.id, r.prediction) for r in models.score_forest(forest, sides[1]).select("id", "prediction").collect())
    assert ours == theirs


def test_boosted_scores(sides, boosted, tmp_path):
    path = str(tmp_path / "boosted")
    models.save_model(boosted, path)
    scored = models.score_boosted(models.load_model(path), sides[1])
    assert outcome(scored) == outcome(models.score_boosted(boosted, sides[1]))
    total = sum(F.col(f"probability_s{c}") for c in (2, 3, 4)) + F.col("probability_s1")
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    # plumbing check: severity follows from a feature of this table
    accuracy = scored.agg(F.avg((F.col("severity") == F.col("predicted_severity")).cast("int"))).first()[0]
    assert accuracy > 0.8


def test_boosted_scoring_stays_in_the_jvm(sides, boosted):
    plan = models.score_boosted(boosted, sides[1])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_importances_are_ranked_and_sum_to_one(forest, boosted):
    for model, names in ((forest, features.FOREST_FEATURES), (boosted, features.BOOSTED_FEATURES)):
        rows = models.feature_importance(model).collect()
        assert {r.feature for r in rows} == set(names)
        values = [r.importance for r in rows]
        assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)


def test_weighted_forest(sides):
    model = models.train_weighted_forest(sides[0], trees=5, depth=6)
    scored = models.score_weighted_forest(model, sides[1])
    assert scored.count() == features.weighted_frame(sides[1]).count()
    assert {r.predicted_severity for r in scored.select("predicted_severity").distinct().collect()} == {1, 2, 3, 4}


def test_metrics_equal_the_library_s(sides, forest):
    scored = models.score_forest(forest, features.labelled(sides[1])).select("label", "prediction").cache()
    ours = evaluation.overall_metrics(evaluation.confusion_counts(scored)).first()
    for ours_name, theirs in [("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"),
                              ("weighted_recall", "weightedRecall")]:
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=theirs)
        assert ours[ours_name] == pytest.approx(evaluator.evaluate(scored))


def test_class_never_predicted_has_zero_ratios(spark):
    pairs = [(0.0, 1.0), (0.0, 1.0), (1.0, 1.0), (2.0, 2.0), (2.0, 1.0)]
    counts = evaluation.confusion_counts(spark.createDataFrame(pairs, "label double, prediction double"))
    report = {r["class"]: r for r in evaluation.class_report(counts).collect()}
    assert (report[0].precision, report[0].recall, report[0].f1, report[0].support) == (0.0, 0.0, 0.0, 2)
    assert report[2].precision == 1.0 and report[2].recall == 0.5
    matrix = [tuple(r) for r in evaluation.confusion_matrix(counts).collect()]
    assert matrix == [(0, 0, 2, 0, 0, 0), (1, 0, 1, 0, 0, 0), (2, 0, 1, 1, 0, 0), (3, 0, 0, 0, 0, 0)]


def test_confusion_matrix_counts_every_row(spark):
    pairs = [(0.0, None), (0.0, 7.0), (5.0, 1.0), (None, None), (1.0, 1.0)]
    counts = evaluation.confusion_counts(spark.createDataFrame(pairs, "label double, prediction double"))
    matrix = {r[0]: tuple(r)[1:] for r in evaluation.confusion_matrix(counts).collect()}
    assert (matrix[0], matrix[5], matrix[None]) == ((0, 0, 0, 0, 2), (0, 1, 0, 0, 0), (0, 0, 0, 0, 1))
    assert sum(map(sum, matrix.values())) == len(pairs)


def test_rule_probabilities_sum_to_one(accidents):
    scored = rules.score_by_rule(accidents)
    total = sum(F.col(f"probability_s{c}") for c in (2, 3, 4)) + F.col("probability_s1")
    assert scored.filter("risk IS NOT NULL").filter(F.abs(total - 1) > 1e-9).count() == 0
    assert scored.filter("risk IS NULL AND predicted_severity IS NOT NULL").count() == 0


def test_no_row_is_lost_by_a_null_key(make):
    table = make([{"id": None, "severity": 2}, {"id": None, "severity": 3}, {"id": "A", "severity": 2}])
    train, test = splits.hash_split(table)
    assert train.count() + test.count() == 3
    assert splits.stratified_split(features.labelled(table)).filter("split IS NULL").count() == 0


def test_parts_grow_with_the_rows_of_the_input(spark, monkeypatch):
    monkeypatch.setattr(models, "MOST_ROWS", 10)
    parts = lambda n, least: models._spread(spark.range(n), least).rdd.getNumPartitions()
    assert [parts(n, 4) for n in (1, 30, 40, 41, 95)] == [4, 4, 4, 5, 10]
    assert models._spread(spark.range(95).coalesce(1), None).rdd.getNumPartitions() == 1
