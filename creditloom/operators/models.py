"""Default-probability models on Spark ML."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators import prep
from creditloom.operators.metrics import grouped_metrics, metric_suite
from creditloom.session import cut_lineage, ensure_checkpoint_dir

SEED = 42
VECTOR = "features_vector"
# Rows that one task of a fit has at least: the many short jobs of a small fit run in few tasks.
ROWS_PER_TASK = 50_000
# Fits that run side by side; each is a sequence of jobs, which alone leaves executors idle.
SIDE_BY_SIDE = 8
# Trees of a boosted fit.
TREES = 200


def fitted_numbers(train: DataFrame, features) -> dict[str, tuple[float, float, float]]:
    """Median, centre and scale of each feature in the order of assembly: robust block first."""
    robust, standard = prep.feature_groups(features)
    fitted = prep.fitted_rows(prep.fit_scaling(train, robust + standard))
    return {f: fitted[f] for f in robust + standard}


def stages_of(fitted: dict[str, tuple[float, float, float]]) -> list:
    """Imputation and scaling with ``fitted_numbers``, then assembly."""
    columns = [f"(coalesce(CAST({f} AS DOUBLE), {m!r}D) - {c!r}D) / {s!r}D AS scaled_{f}" for f, (m, c, s) in fitted.items()]
    statement = "SELECT *, " + ", ".join(columns) + " FROM __THIS__"
    return [
        SQLTransformer(statement=statement),
        VectorAssembler(inputCols=[f"scaled_{f}" for f in fitted], outputCol=VECTOR),
    ]


def preprocessing_stages(train: DataFrame, features) -> list:
    """Imputation and scaling with fitted numbers, then assembly: robust block first."""
    return stages_of(fitted_numbers(train, features))


def estimator(model_type: str, n_rows: int, n_trees: int | None = None):
    """'boosted' or 'logistic'; anything else is an error."""
    if model_type == "boosted":
        return GBTClassifier(
            featuresCol=VECTOR, labelCol="label", maxIter=n_trees or TREES, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, seed=SEED
        )
    if model_type == "logistic":
        # An inverse penalty C on a sum of losses is 1 / (C n) on their mean.
        return LogisticRegression(
            featuresCol=VECTOR, labelCol="label", weightCol="weight", regParam=1.0 / (0.1 * n_rows),
            elasticNetParam=0.0, standardization=False, maxIter=1000,
        )
    raise ValueError(f"unknown model type: {model_type}")


def in_even_waves(data: DataFrame, n_rows: int) -> DataFrame:
    """The rows of a fit in few tasks, or in equal tasks that fill every slot the same number of times.

    A fit is a thousand short jobs, each of which waits for its last task: one part more than
    there are slots, as the files of a table may give, doubles them all.
    """
    parts, slots = max(1, math.ceil(n_rows / ROWS_PER_TASK)), data.sparkSession.sparkContext.defaultParallelism
    if parts <= slots:
        return data.coalesce(parts)
    return data.repartition(slots * math.ceil(parts / slots))


def prepared(train: DataFrame, features=None, label: str = "defaulted", select_best: int | None = None) -> tuple[dict, DataFrame, int]:
    """The fitted numbers, the weighted rows and their number: what fits of any model on ``train`` share."""
    ensure_checkpoint_dir(train.sparkSession)
    train = train.where(F.col(label).isNotNull())
    usable = set(prep.available_features(train))
    features = [f for f in features or prep.NUMERIC_FEATURES if f in usable]
    if select_best:
        features = prep.select_k_best(train, features, min(select_best, len(features)), label)
    fitted = fitted_numbers(train, features)
    n_rows = train.count()
    data = prep.with_class_weight(train, label).withColumn("label", F.col(label).cast("double"))
    return fitted, in_even_waves(data, n_rows), n_rows


def fit_prepared(rows: tuple[dict, DataFrame, int], model_type: str, n_trees: int | None = None) -> PipelineModel:
    """Fit a model on what ``prepared`` returned."""
    fitted, data, n_rows = rows
    return Pipeline(stages=[*stages_of(fitted), estimator(model_type, n_rows, n_trees)]).fit(data)


def fit(
    train: DataFrame, model_type: str, features=None, label: str = "defaulted", select_best: int | None = None,
    n_trees: int | None = None,
) -> PipelineModel:
    """Fit preprocessing and model on labelled rows; optionally on the k best features only.

    Features without a value among those rows are left out.
    """
    return fit_prepared(prepared(train, features, label, select_best), model_type, n_trees)


def fit_side_by_side(
    wanted: dict, label: str = "defaulted", select_best: int | None = None, n_trees: int | None = None
) -> dict:
    """``{name: (train, model_type, features)}`` to ``{name: model}``; a bounded number at a time.

    Models of one ``train`` and the same features share the preparation of its rows.
    """
    if not wanted:
        return {}
    shared = {name: (id(train), tuple(features or ())) for name, (train, _, features) in wanted.items()}
    sources = {shared[name]: (train, features) for name, (train, _, features) in wanted.items()}
    side = inheritable_thread_target(next(iter(wanted.values()))[0].sparkSession)
    with ThreadPoolExecutor(max_workers=min(SIDE_BY_SIDE, len(wanted))) as pool:
        started = {k: pool.submit(side(prepared), train, features, label, select_best) for k, (train, features) in sources.items()}
        rows = {k: run.result() for k, run in started.items()}
        started = {name: pool.submit(side(fit_prepared), rows[shared[name]], m, n_trees) for name, (_, m, _) in wanted.items()}
        return {name: run.result() for name, run in started.items()}


def score(model: PipelineModel, rows: DataFrame, keep) -> DataFrame:
    """Probability of default for each row."""
    return model.transform(rows).select(*keep, vector_to_array("probability")[1].alias("p"))


def assembled_names(model: PipelineModel) -> list[str]:
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return [c.removeprefix("scaled_") for c in assembler.getInputCols()]


def feature_importance(spark: SparkSession, model: PipelineModel, top: int | None = 15) -> DataFrame:
    """(feature, importance), names taken from the assembler; one row per model feature."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(assembled_names(model), weights)]
    ranked = spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    weights = model.stages[-1].coefficients.toArray()
    return spark.createDataFrame(
        [(n, float(w)) for n, w in zip(assembled_names(model), weights)], "feature STRING, coefficient DOUBLE"
    )


def loss_slopes(model: PipelineModel, train: DataFrame, label: str, weight: str) -> DataFrame:
    """(feature, slope): derivative of the penalised mean loss for each coefficient.

    Near zero everywhere at the optimum; the intercept is not penalised.
    """
    fitted, names = model.stages[-1], assembled_names(model)
    scored = model.transform(train).withColumn("_x", vector_to_array(VECTOR))
    residual = F.col(weight) * (vector_to_array("probability")[1] - F.col(label))
    sums = scored.agg(
        F.sum(weight).alias("w"), F.sum(residual).alias("r"), *[F.sum(residual * F.col("_x")[i]).alias(f"r{i}") for i in range(len(names))]
    ).first()
    penalty = fitted.getRegParam()
    rows = [(n, sums[f"r{i}"] / sums["w"] + penalty * float(c)) for i, (n, c) in enumerate(zip(names, fitted.coefficients.toArray()))]
    return train.sparkSession.createDataFrame([*rows, ("(intercept)", sums["r"] / sums["w"])], "feature STRING, slope DOUBLE")


def linear_explanation(scaled_rows: DataFrame, weights: DataFrame, features, key: str = "company_id") -> DataFrame:
    """coefficient x scaled value of each feature, one row per (company, feature)."""
    long = prep.long_features(scaled_rows, features, [key])
    return long.join(F.broadcast(weights), "feature").select(
        key, "feature", "value", "coefficient", (F.col("coefficient") * F.col("value")).alias("contribution")
    )


def evaluate(model: PipelineModel, rows: DataFrame, label: str = "defaulted") -> DataFrame:
    return metric_suite(score(model, rows, [F.col(label).alias("y")]))


def cross_validate(
    data: DataFrame, folds: DataFrame, model_types, features, key: str = "company_id", label: str = "defaulted",
    n_trees: int | None = None, extra: dict[str, Column] | None = None,
) -> DataFrame:
    """(fold, role, model, n_rows, n_defaulted, metrics) for each temporal fold and model.

    Folds are few.  Their rows are written once, the fits run side by side, and the scores of all
    folds and models are measured as one table.  ``extra`` names further aggregates over the
    label ``y`` and the probability ``p``.  A fold whose training rows have one class only is left
    out; rank metrics of rows of one class are null.  Without a fold there are no rows.
    """
    rows = cut_lineage(data.join(folds.select(key, "fold", "role"), key))
    classes = rows.where("role = 'train'").groupBy("fold").agg(F.countDistinct(label).alias("n"))
    numbers = sorted(r["fold"] for r in classes.where("n > 1").collect())
    trains = {i: rows.where((F.col("fold") == i) & (F.col("role") == "train")) for i in numbers}
    fitted = fit_side_by_side({(i, m): (train, m, features) for i, train in trains.items() for m in model_types}, label=label, n_trees=n_trees)
    keep = ["fold", "role", F.col(label).alias("y")]
    scored = [
        score(model, rows.where(F.col("fold") == i), keep).withColumn("model", F.lit(m)) for (i, m), model in fitted.items()
    ]
    if not scored:
        scored = [rows.limit(0).select(*keep, F.lit(None).cast("double").alias("p"), F.lit("").alias("model"))]
    return grouped_metrics(cut_lineage(reduce(DataFrame.unionByName, scored)), ["fold", "role", "model"], extra=extra)


def mean_over_folds(fold_metrics: DataFrame) -> DataFrame:
    """(model, role, mean metrics, n_folds); a null metric of a fold is skipped."""
    names = ["auc_roc", "ks_statistic", "brier_score"]
    return fold_metrics.groupBy("model", "role").agg(*[F.avg(m).alias(m) for m in names], F.count("*").alias("n_folds"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
