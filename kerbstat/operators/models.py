"""Severity models: training, storage, scoring and importances."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstat.functions import clock
from kerbstat.operators import boosting, forest
from kerbstat.operators import features as feat
from kerbstat.session import ensure_checkpoint_dir, scratch_dir

CLASSES = (0, 1, 2, 3)
OUTCOME = ("prediction", "predicted_severity", *[f"probability_s{c + 1}" for c in CLASSES])


# --- training ------------------------------------------------------------------------


MOST_ROWS = 250_000  # of a task, where the input is spread


def _spread(frame: DataFrame, partitions: int | None) -> DataFrame:
    """The frame in at least so many parts, and in so many that tasks stay small as the input grows."""
    if partitions is None:
        return frame
    return frame.repartition(max(partitions, -(-frame.count() // MOST_ROWS)))


# Node ids are kept per row and checkpointed, so that a pass need not walk and ship whole trees; more memory means fewer passes.
NODE_IDS = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 1024}


def train_forest(
    df: DataFrame, *, trees: int = 50, depth: int = 10, seed: int = 42, partitions: int | None = None
) -> PipelineModel:
    """Impute, assemble and fit a random forest on labelled accidents.

    Training runs as many tasks as the input has partitions. ``partitions`` spreads an
    input that has fewer than there are cores, as one unsplittable file has; more rows get more parts.
    """
    ensure_checkpoint_dir(df.sparkSession)
    classifier = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **NODE_IDS)
    frame = feat.labelled(feat.forest_frame(df)).select(*feat.FOREST_FEATURES, "label")
    stages = [feat.mean_imputer(), feat.assembler(feat.FOREST_FEATURES), classifier]
    return Pipeline(stages=stages).fit(_spread(frame, partitions))


def train_weighted_forest(
    df: DataFrame, *, trees: int = 100, depth: int = 30, seed: int = 42, partitions: int | None = None
) -> PipelineModel:
    """A forest in which every class weighs the same.

    Trees grow to ``depth``, by default the 30 levels that the library allows. The model is the library's; the
    trees are grown by ``operators.forest``, whose passes over the table do not multiply with their depth.
    """
    spark, folder = df.sparkSession, scratch_dir(df.sparkSession, "forest-rows")
    frame = feat.labelled(feat.weighted_frame(df)).select(*feat.WEIGHTED_FEATURES, "label")
    frame.write.parquet(folder)
    rows = spark.read.schema(frame.schema).parquet(folder)
    weights = {int(r["label"]): r["weight"] for r in feat.class_weights(rows).collect()}
    if not all(0 <= c < 100 for c in weights):
        raise ValueError("labels count from 0 and stay below 100")
    each = [weights.get(c, 0.0) for c in range(max([len(CLASSES), *(c + 1 for c in weights)]))]
    model = forest.fit(rows, _spread(rows, partitions), feat.WEIGHTED_FEATURES, each, trees=trees, depth=depth, seed=seed)
    return PipelineModel(stages=[feat.assembler(feat.WEIGHTED_FEATURES), model])


def train_boosted(
    df: DataFrame,
    *,
    rounds: int = 300,
    depth: int = 8,
    step: float = 0.1,
    row_fraction: float = 0.8,
    feature_fraction: float = 0.8,
    bins: int = boosting.BINS,
    seed: int = 42,
    partitions: int | None = None,
) -> PipelineModel:
    """Gradient-boosted trees under one softmax over the four classes, in a single stored pipeline.

    The pipeline encodes the categories and holds one ensemble per class, whose margins the score turns into probabilities.
    """
    spark = df.sparkSession
    frame = feat.labelled(feat.boosted_frame(df))
    inputs = [f for f in feat.BOOSTED_FEATURES if f not in feat.CODES]
    frame = _spread(frame.select(*inputs, *feat.CATEGORIES, "label"), partitions)
    encoding = Pipeline(
        stages=[feat.category_encoder(), feat.plain_codes(), feat.assembler(feat.BOOSTED_FEATURES)]
    ).fit(frame)
    trees, edges = boosting.fit(
        encoding.transform(frame),
        feat.BOOSTED_FEATURES,
        classes=len(CLASSES),
        rounds=rounds,
        depth=depth,
        step=step,
        row_fraction=row_fraction,
        feature_fraction=feature_fraction,
        bins=bins,
        seed=seed,
    )
    stages = [boosting.as_regression(spark, [t[c] for t in trees], edges, step, f"margin_{c}") for c in CLASSES]
    return PipelineModel(stages=[*encoding.stages, *stages])


# --- storage -------------------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | None:
    """The stored pipeline, or None where there is none."""
    metadata = f"{path}/metadata"
    spark = SparkSession.active()
    try:
        spark.read.text(metadata)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return PipelineModel.load(path)


# --- scoring -------------------------------------------------------------------------


def _with_outcome(scored: DataFrame, probabilities: Column) -> DataFrame:
    """Probabilities by severity level, and the most likely severity (counted from 1)."""
    named = {f"probability_s{c + 1}": F.coalesce(F.get(F.col("__p"), F.lit(c)), F.lit(0.0)) for c in CLASSES}
    best = F.array_position(F.col("__p"), F.array_max("__p"))
    return (
        scored.withColumn("__p", probabilities)
        .withColumns({**named, "predicted_severity": best.cast("int")})
        .withColumn("prediction", (F.col("predicted_severity") - 1).cast("double"))
        .drop("__p")
    )


def score_forest(model: PipelineModel, df: DataFrame, *, keep_unscored: bool = False) -> DataFrame:
    """Batch or stream: accidents with ``prediction``, ``predicted_severity`` and four probabilities.

    The measures that the model imputes keep their own values in the result. The model needs a time: rows without
    one are left out, as in training, or kept with a null outcome if ``keep_unscored`` is set.
    """
    own = df.columns
    originals = {f"__{c}": F.col(c) for c in feat.IMPUTED}
    frame = feat.forest_frame(df).withColumns(originals)
    if keep_unscored:
        frame = frame.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("hour_of_day", "day_of_week")})
    scored = model.transform(frame)
    result = _with_outcome(scored.drop("prediction"), vector_to_array("probability"))
    if keep_unscored:
        result = result.withColumns({c: F.when(F.col("start_time").isNotNull(), F.col(c)) for c in OUTCOME})
    return _only(result, own, renamed=set(feat.IMPUTED))


def score_weighted_forest(model: PipelineModel, df: DataFrame, *, keep_unscored: bool = False) -> DataFrame:
    """Batch or stream: rows without one of the nine features are left out, or kept with a null outcome if ``keep_unscored`` is set."""
    own = df.columns
    frame = _marked(df, feat.weighted_frame, feat.WEIGHTED_FEATURES) if keep_unscored else feat.weighted_frame(df)
    scored = model.transform(frame)
    return _finished(_with_outcome(scored.drop("prediction"), vector_to_array("probability")), own, keep_unscored)


def score_boosted(model: PipelineModel, df: DataFrame, *, keep_unscored: bool = False) -> DataFrame:
    """Batch or stream: accidents with the outcome of the boosted model, the softmax of its margins.

    Rows without one of the features are left out, as in training, or kept with a null outcome if ``keep_unscored`` is set.
    """
    own = df.columns
    frame = _marked(df, feat.boosted_frame, [f for f in feat.BOOSTED_FEATURES if f not in feat.CODES]) if keep_unscored else feat.boosted_frame(df)
    scored = model.transform(frame)
    margins = [F.col(s.getPredictionCol()) for s in model.stages if isinstance(s, GBTRegressionModel)]
    largest = F.greatest(*margins)
    odds = [F.exp(m - largest) for m in margins]
    total = sum(odds[1:], odds[0])
    return _finished(_with_outcome(scored, F.array(*[o / total for o in odds])), own, keep_unscored)


SCORABLE = "__scorable"


def _marked(df: DataFrame, frame: Callable[[DataFrame], DataFrame], needed: Sequence[str]) -> DataFrame:
    """The frame of all rows: what a row lacks is filled with zeros, and ``SCORABLE`` tells whether it lacked nothing.

    The table's own columns are kept aside, since the frames rewrite some of them.
    """
    kept = {f"__own_{c}": F.col(c) for c in df.columns}
    dated = {"hour": F.hour("start_time"), "day_of_week": F.weekday("start_time"), "month": F.month("start_time")}
    whole = [dated[c].isNotNull() if c in dated and c not in df.columns else F.col(c).isNotNull() for c in needed]
    known = [~F.isnan(c) for c in needed if dict(df.dtypes).get(c) == "double"]
    scorable = functools.reduce(operator.and_, [*whole, *known])
    filled = {}
    for name, kind in df.dtypes:
        if name in needed:
            filled[name] = F.coalesce(F.nanvl(name, F.lit(0.0)) if kind == "double" else F.col(name), F.lit(False if kind == "boolean" else 0).cast(kind))
    if any(c in dated for c in needed):
        filled["start_time"] = F.coalesce("start_time", clock.moment(dt.datetime(1970, 1, 1)).cast(dict(df.dtypes)["start_time"]))
    return frame(df.withColumns({**kept, SCORABLE: scorable}).withColumns(filled))


def _finished(result: DataFrame, own: list[str], keep_unscored: bool) -> DataFrame:
    """The table's own columns and the outcome, which is null where the row could not be scored."""
    if not keep_unscored:
        return _only(result, own)
    outcome = [F.when(F.col(SCORABLE), F.col(c)).alias(c) for c in OUTCOME]
    return result.select(*[F.col(f"__own_{c}").alias(c) for c in own if c not in OUTCOME], *outcome)


SCORERS = {"forest": score_forest, "weighted": score_weighted_forest, "boosted": score_boosted}


def kind_of(model: PipelineModel) -> str:
    """``forest``, ``weighted`` or ``boosted``, by what the pipeline holds: a booster holds regressions, and the forests differ by their features."""
    if any(isinstance(s, GBTRegressionModel) for s in model.stages):
        return "boosted"
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return "weighted" if tuple(inputs) == feat.WEIGHTED_FEATURES else "forest"


def score(model: PipelineModel, df: DataFrame, *, keep_unscored: bool = False) -> DataFrame:
    """Batch or stream: the outcome of whichever of the three models this is."""
    return SCORERS[kind_of(model)](model, df, keep_unscored=keep_unscored)


def _only(result: DataFrame, own: list[str], renamed: set[str] = frozenset()) -> DataFrame:
    return result.select(
        *[F.col(f"__{c}").alias(c) if c in renamed else F.col(c) for c in own if c not in OUTCOME], *OUTCOME
    )


# --- inspection ----------------------------------------------------------------------


def feature_importance(model: PipelineModel) -> DataFrame:
    """Features by importance; for the boosted model, the mean over its classes."""
    trees = [s for s in model.stages if hasattr(s, "featureImportances")]
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    vectors = [t.featureImportances.toArray() for t in trees]
    vectors = [v for v in vectors if v.sum() > 0] or vectors
    rows = [(name, float(sum(v[i] for v in vectors) / len(vectors))) for i, name in enumerate(names)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
