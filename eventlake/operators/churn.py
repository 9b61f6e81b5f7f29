"""Churn features, label, model and metrics (Spark ML).

Features per entity (default ``repo_id``) over the train window
``event_date < split_date``; label ``churned = 1`` when the entity has no
event on or after the split. Both windows come from **one** grouped pass with
conditional aggregates (one scan, one shuffle on the entity), which equals the
train-aggregate LEFT JOIN holdout-count form.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.columns import hash_bucket
from eventlake.schema import FEATURE_COLUMNS, LABEL_COLUMN, check_contract, features_schema
from eventlake.session import scratch_dir


@dataclass(frozen=True)
class ChurnConfig:
    split_date: dt.date
    min_events_in_train: int = 5
    entity: str = "repo_id"
    #: counted as ``n_actors``: the other side of the entity (actors of a repo,
    #: repos of an actor)
    distinct_col: str = "actor_id"
    train_fraction: int = 70  # percent
    seed: int = 42
    max_iter: int = 50
    reg_param: float = 0.0


def _split(config: ChurnConfig) -> Column:
    return F.lit(config.split_date)


def build_features(events: DataFrame, config: ChurnConfig) -> DataFrame:
    """One row per entity with >= ``min_events_in_train`` train events.

    ``events`` is the event fact, or the (repo, actor, day, type) activity
    rollup (then counts are weighted by its ``n_events``). NULL entity keys are
    dropped, as the dimensions do.
    """
    in_train = F.col("event_date") < _split(config)
    weighted = "n_events" in events.columns and "first_seen_at" in events.columns
    weight = F.col("n_events") if weighted else F.lit(1)

    def train_count(cond: Column | None = None) -> Column:
        hit = in_train if cond is None else (in_train & cond)
        return F.sum(F.when(hit, weight).otherwise(F.lit(0))).cast("bigint")

    def train_distinct(col: str) -> Column:
        return F.count_distinct(F.when(in_train, F.col(col)))

    grouped = (
        events.where(F.col(config.entity).isNotNull())
        .groupBy(config.entity)
        .agg(
            train_count().alias("n_events"),
            train_distinct(config.distinct_col).alias("n_actors"),
            train_distinct("event_type").alias("n_event_types"),
            train_distinct("event_date").alias("days_active"),
            train_count(F.col("event_type") == "PushEvent").alias("push_count"),
            train_count(F.col("event_type") == "PullRequestEvent").alias("pr_count"),
            train_count(F.col("event_type") == "IssuesEvent").alias("issue_count"),
            F.sum(F.when(~in_train, weight).otherwise(F.lit(0))).cast("bigint").alias("holdout_events"),
        )
    )
    min_events = max(int(config.min_events_in_train), 1)
    n = F.col("n_events").cast("double")
    features = (
        grouped.where(F.col("n_events") >= F.lit(min_events))
        .withColumns(
            {
                "push_ratio": F.col("push_count") / n,
                "pr_ratio": F.col("pr_count") / n,
                "issue_ratio": F.col("issue_count") / n,
                LABEL_COLUMN: (F.col("holdout_events") == 0).cast("int"),
            }
        )
        .select(config.entity, *FEATURE_COLUMNS, LABEL_COLUMN)
    )
    return check_contract(features, features_schema(config.entity), name="churn features")


def churn_rate(features: DataFrame) -> DataFrame:
    """One row: total entities, churned entities and their share."""
    return features.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(LABEL_COLUMN), F.lit(0)).cast("bigint").alias("churned"),
        F.avg(F.col(LABEL_COLUMN).cast("double")).alias("churn_rate"),
    )


def split(features: DataFrame, config: ChurnConfig, method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """Train/test split.

    ``hash`` (default): by a hash of the entity key, so the same entity always
    lands on the same side whatever the partitioning. ``random``: Spark's
    seeded ``randomSplit`` (depends on partitioning and row order).
    """
    if method == "random":
        frac = config.train_fraction / 100.0
        train_df, test_df = features.randomSplit([frac, 1.0 - frac], seed=config.seed)
        return train_df, test_df
    if method != "hash":
        raise ValueError(f"split method must be 'hash' or 'random', got {method!r}")
    bucket = hash_bucket([config.entity], config.seed)
    return (
        features.where(bucket < F.lit(config.train_fraction)),
        features.where(bucket >= F.lit(config.train_fraction)),
    )


def pipeline(config: ChurnConfig) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features")
    lr = LogisticRegression(
        featuresCol="features", labelCol=LABEL_COLUMN, maxIter=config.max_iter, regParam=config.reg_param
    )
    return Pipeline(stages=[assembler, lr])


def metrics_frame(preds: DataFrame) -> DataFrame:
    """Class counts of a scored test set (one row); AUC needs both classes."""
    return preds.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count_if(F.col(LABEL_COLUMN) == 1).alias("test_churned"),
    )


def evaluate(preds: DataFrame, n_test: int | None = None, n_pos: int | None = None) -> tuple[float | None, float | None]:
    """Accuracy and area under the ROC curve of scored rows; None where undefined."""
    if n_test is None or n_pos is None:
        counts = metrics_frame(preds).first()
        n_test, n_pos = counts["test_rows"], counts["test_churned"]
    accuracy = MulticlassClassificationEvaluator(labelCol=LABEL_COLUMN, metricName="accuracy")
    # numBins 0: every distinct score is a point of the curve
    auc = BinaryClassificationEvaluator(labelCol=LABEL_COLUMN, metricName="areaUnderROC", numBins=0)
    return (accuracy.evaluate(preds) if n_test else None), (auc.evaluate(preds) if 0 < n_pos < n_test else None)


def train(features: DataFrame, config: ChurnConfig, spark: SparkSession | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train side, score the test side; return the model and a
    one-row metrics DataFrame (``roc_auc`` NULL when the test side holds a
    single class, ``accuracy`` NULL when it is empty)."""
    features = features.persist()
    try:
        totals = churn_rate(features).first()
        if not totals or totals["total"] == 0:
            raise RuntimeError("no training rows: lower min_events_in_train or load more days")
        train_df, test_df = split(features, config)
        if train_df.isEmpty():
            raise RuntimeError("no rows on the train side of the split: load more data or change train_fraction")
        spark = spark or features.sparkSession
        model = _detached(pipeline(config).fit(train_df), spark)
        preds = model.transform(test_df).persist()
        counts = metrics_frame(preds).first()
        n_test, n_pos = counts["test_rows"], counts["test_churned"]
        accuracy, auc = evaluate(preds, n_test, n_pos)
        preds.unpersist()
        row = {
            "split_date": config.split_date.isoformat(),
            "min_events_in_train": int(config.min_events_in_train),
            "total": int(totals["total"]),
            "churned": int(totals["churned"]),
            "churn_rate": float(totals["churn_rate"]),
            "train_rows": int(totals["total"]) - int(n_test),
            "test_rows": int(n_test),
            "test_churned": int(n_pos),
            "accuracy": None if accuracy is None else float(accuracy),
            "roc_auc": None if auc is None else float(auc),
        }
        schema = (
            "split_date string, min_events_in_train int, total bigint, churned bigint, churn_rate double, "
            "train_rows bigint, test_rows bigint, test_churned bigint, accuracy double, roc_auc double"
        )
        return model, spark.createDataFrame([row], schema)
    finally:
        features.unpersist()


def _detached(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The fitted pipeline written to the shared checkpoint folder and loaded
    back. A freshly fitted model keeps its training summary, which references
    the session; once the session has run an ``observe`` that reference can no
    longer be serialised into scoring tasks. The loaded copy has no summary."""
    path = scratch_dir(spark, "churn-model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_run(metrics: DataFrame, config: ChurnConfig, path: str, run_id: str | None = None, model_path: str | None = None) -> None:
    """Append the run's parameters and metrics to an ``ml_runs`` dataset, with its id and where its model lies."""
    params = {k: str(v) for k, v in asdict(config).items()}
    out = metrics.withColumns(
        {
            "params": F.create_map(*[x for k, v in sorted(params.items()) for x in (F.lit(k), F.lit(v))]),
            "feature_columns": F.lit(",".join(FEATURE_COLUMNS)),
            "run_id": F.lit(run_id).cast("string"),
            "model_path": F.lit(model_path).cast("string"),
            "logged_at": F.current_timestamp(),
        }
    )
    out.coalesce(1).write.mode("append").parquet(path)


# ---------------------------------------------------------------------------
# what a fit says, and scoring by a saved model
# ---------------------------------------------------------------------------


def coefficients(model: PipelineModel) -> tuple[dict[str, float], float]:
    """Coefficient of each feature, and the intercept."""
    fitted = model.stages[-1]
    return dict(zip(FEATURE_COLUMNS, [float(c) for c in fitted.coefficients], strict=True)), float(fitted.intercept)


def formula(model: PipelineModel) -> Column:
    """The probability of churn as a plain expression of the feature columns."""
    weights, intercept = coefficients(model)
    linear = reduce(Column.__add__, [F.lit(w) * F.col(c).cast("double") for c, w in weights.items()], F.lit(intercept))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))


def fit_conditions(model: PipelineModel, train: DataFrame, config: ChurnConfig) -> DataFrame:
    """``term, slope``: the first-order conditions of the fit, one row per coefficient.

    At the minimum the mean of (p - label) times a feature, plus its penalty
    ``reg_param * coefficient * variance`` (features are penalised at unit
    spread), is zero. Slopes are given per standard deviation of the feature; the
    intercept has no penalty. One aggregate over the train rows.
    """
    weights, _ = coefficients(model)
    error = formula(model) - F.col(LABEL_COLUMN)
    one = [F.avg(error * F.col(c)).alias(f"m_{c}") for c in FEATURE_COLUMNS] + [F.stddev_samp(c).alias(f"s_{c}") for c in FEATURE_COLUMNS]
    sums = train.agg(F.avg(error).alias("m"), *one)
    rows = [F.struct(F.lit("intercept").alias("term"), F.col("m").alias("slope"))]
    for c in FEATURE_COLUMNS:
        spread = F.col(f"s_{c}")
        slope = F.col(f"m_{c}") / spread + F.lit(config.reg_param * weights[c]) * spread
        rows.append(F.struct(F.lit(c).alias("term"), F.when(spread > 0, slope).otherwise(F.lit(0.0)).alias("slope")))
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def best_run(spark: SparkSession, path: str, metric: str = "roc_auc") -> dict:
    """The recorded run with the largest value of a metric (ties: the latest) whose model is kept."""
    runs = spark.read.option("mergeSchema", "true").parquet(path)
    if metric not in ("roc_auc", "accuracy"):
        raise ValueError(f"no such metric: {metric!r}")
    usable = runs.where(F.col("model_path").isNotNull() & F.col(metric).isNotNull())
    best = usable.orderBy(F.col(metric).desc(), F.col("logged_at").desc()).limit(1).collect()
    if not best:
        raise LookupError(f"no run with a model and a {metric} in {path}")
    return best[0].asDict(recursive=True)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """All columns of ``features`` with ``score`` (probability of churn) and ``prediction``; narrow, row by row on the JVM."""
    scored = model.transform(features)
    return scored.select(*features.columns, vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("prediction"))
