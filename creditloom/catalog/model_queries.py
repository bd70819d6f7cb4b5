"""Queries over training-set preparation and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.catalog.feature_queries import training
from creditloom.catalog.fixtures import cte, view
from creditloom.catalog.registry import oracle, query
from creditloom.catalog.score_queries import FEATURES
from creditloom.operators import metrics, models, prep
from creditloom.session import cut_lineage
from creditloom.streaming.feeds import work_folder

ROBUST, STANDARD = prep.feature_groups(FEATURES)
ORDER = ROBUST + STANDARD
KEY = "company_id"
MODELS = ("boosted", "logistic")


def ready(spark, sf):
    """The training table, written once: fitting reads it many times."""
    return cut_lineage(training(spark, sf))


def _q(f, p):
    return f"(SELECT quantile_cont(CAST({f} AS DOUBLE), {p}) FROM {{t}})"


cte(
    "imputed",
    "training",
    "SELECT company_id, defaulted, "
    + ", ".join(f"coalesce(CAST({f} AS DOUBLE), (SELECT median(CAST({f} AS DOUBLE)) FROM training)) AS {f}" for f in ORDER)
    + " FROM training",
)


def _scaled_sql(f):
    if f in ROBUST:
        center, scale = f"median({f})", f"quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25)"
    else:
        center, scale = f"avg({f})", f"stddev_pop({f})"
    return f"({f} - (SELECT {center} FROM imputed)) / (SELECT CASE WHEN {scale} = 0 THEN 1 ELSE {scale} END FROM imputed) AS {f}"


cte("scaled", "imputed", "SELECT company_id, " + ", ".join(_scaled_sql(f) for f in ORDER) + " FROM imputed")

query(
    "ml_available_features",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, {i} AS position, count({f}) AS n_present FROM training HAVING count({f}) > 0"
            for i, f in enumerate(prep.NUMERIC_FEATURES)
        ),
        "feature position n_present", uses="training",
    ),
)(lambda spark, sf: prep.feature_counts(training(spark, sf)).where("n_present > 0"))


@query(
    "ml_feature_groups",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, {'true' if f in ROBUST else 'false'} AS robust, {i} AS position, count({f}) AS n_present FROM training"
            for i, f in enumerate(ORDER)
        ),
        "feature robust position n_present", uses="training",
    ),
)
def _(spark, sf):
    counts = prep.feature_counts(training(spark, sf)).where("n_present > 0").drop("position")
    places = spark.createDataFrame(
        [(f, f in ROBUST, i) for i, f in enumerate(ORDER)], "feature STRING, robust BOOLEAN, position INT"
    )
    return counts.join(F.broadcast(places), "feature")


@query("ml_impute_median", oracle("SELECT * FROM imputed", KEY, " ".join(ORDER), uses="imputed"))
def _(spark, sf):
    rows = ready(spark, sf)
    return prep.impute(rows, prep.fit_medians(rows, ORDER), ORDER, [KEY])


def _scaled(spark, sf, features):
    rows = ready(spark, sf)
    return prep.scale(rows, prep.fit_scaling(rows, features), features, [KEY])


query("ml_robust_scale", oracle("SELECT * FROM scaled", KEY, " ".join(ROBUST), uses="scaled"))(
    lambda spark, sf: _scaled(spark, sf, ROBUST)
)
query("ml_standard_scale", oracle("SELECT * FROM scaled", KEY, " ".join(STANDARD), uses="scaled"))(
    lambda spark, sf: _scaled(spark, sf, STANDARD)
)


@query(
    "ml_assemble",
    oracle(
        " UNION ALL ".join(f"SELECT company_id, {i} AS position, {f} AS value FROM scaled" for i, f in enumerate(ORDER)),
        "company_id position", "value", uses="scaled",
    ),
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = ready(spark, sf)
    for stage in models.preprocessing_stages(rows, FEATURES):
        rows = stage.transform(rows)
    return rows.select(KEY, F.posexplode(vector_to_array(models.VECTOR)).alias("position", "value"))


@query(
    "ml_select_k_best",
    oracle(
        "SELECT feature, f_value FROM ("
        + " UNION ALL ".join(
            f"SELECT '{f}' AS feature, (sum(n * power(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS f_value FROM "
            f"(SELECT count(*) AS n, avg({f}) AS m, var_pop({f}) AS v, (SELECT avg({f}) FROM imputed) AS g FROM imputed GROUP BY defaulted) x"
            for f in ORDER
        )
        + ") y ORDER BY f_value DESC NULLS LAST, feature LIMIT 15",
        "feature", "f_value", uses="imputed",
    ),
)
def _(spark, sf):
    rows = ready(spark, sf)
    filled = prep.impute(rows, prep.fit_medians(rows, ORDER), ORDER, [KEY, "defaulted"])
    return prep.anova_scores(filled, ORDER).orderBy(F.desc_nulls_last("f_value"), "feature").limit(15)


query(
    "ml_class_weights",
    oracle(
        "SELECT defaulted, count(*) AS n, (SELECT count(*) FROM default_labels) / (2.0 * count(*)) AS weight FROM default_labels GROUP BY 1",
        "defaulted n", "weight", uses="default_labels",
    ),
)(lambda spark, sf: prep.class_weights(view(spark, sf, "default_labels")))
query(
    "ml_temporal_folds",
    oracle(
        "SELECT f AS fold, company_id, CASE WHEN pos < n - (5 - f) * t THEN 'train' ELSE 'test' END AS role FROM ("
        "SELECT company_id, row_number() OVER (ORDER BY application_date, md5(CAST(company_id AS VARCHAR)), company_id) - 1 AS pos, count(*) OVER () AS n, CAST(floor(count(*) OVER () * 0.2) AS BIGINT) AS t FROM default_labels) r "
        "CROSS JOIN (SELECT CAST(unnest(range(0, 5)) AS INT) AS f) k WHERE n - (5 - f) * t > 0 AND t > 0 AND pos < n - (5 - f) * t + t",
        "fold company_id role", uses="default_labels",
    ),
)(lambda spark, sf: prep.temporal_folds(view(spark, sf, "default_labels")))
query(
    "ml_stratified_split",
    oracle(
        "SELECT company_id, defaulted, CASE WHEN pos <= round(n * 0.2) THEN 'test' ELSE 'train' END AS role FROM (SELECT company_id, defaulted, "
        "row_number() OVER (PARTITION BY defaulted ORDER BY md5(concat(company_id, '|42')), company_id) AS pos, count(*) OVER (PARTITION BY defaulted) AS n FROM default_labels) x",
        "company_id defaulted role", uses="default_labels",
    ),
)(lambda spark, sf: prep.stratified_split(view(spark, sf, "default_labels").select(KEY, "defaulted"), "defaulted", KEY))


# --- fitted models --------------------------------------------------------------------------
# Every query fits what it shows.  What SQL cannot know, scores, metrics and importances, is
# returned as numbers; a fit that does not hold what every fit must hold is an error.
def _split(spark, sf):
    rows = cut_lineage(prep.stratified_split(ready(spark, sf), "defaulted", KEY))
    return rows, rows.where("role = 'train'"), rows.where("role = 'test'")


def sound(scores, groups=("model",)):
    """``scores`` (groups, y, p) if all are probabilities that rank the classes; else an error.

    Meant for the rows of the fit, on which any working model ranks better than a constant.
    """
    scores = cut_lineage(scores)
    bad = scores.where(~F.coalesce(F.col("p").between(0.0, 1.0), F.lit(False))).count()
    if bad:
        raise ValueError(f"{bad} scores are no probabilities")
    for r in metrics.grouped_metrics(scores, groups).collect():
        values = [r[m] for m in ("auc_roc", "ks_statistic", "brier_score", "ece")]
        if None in values or not r["auc_roc"] > 0.5 or not 0 <= r["brier_score"] <= 1:
            raise ValueError(f"a fit that does not rank its own rows: {r}")
    return scores


def _scores(fitted, rows, *keep):
    """One table of the scores of several models, by name."""
    parts = [models.score(model, rows, list(keep)).withColumn("model", F.lit(name)) for name, model in fitted.items()]
    return cut_lineage(reduce(DataFrame.unionByName, parts))


def _fits(train, names=MODELS):
    return models.fit_side_by_side({m: (train, m, FEATURES) for m in names})


def _checked(fitted, train):
    """The models, each sound on the rows of its fit."""
    sound(_scores(fitted, train, KEY, F.col("defaulted").alias("y")))
    return fitted


_MODEL_ROWS = "training t CROSS JOIN (VALUES ('boosted'), ('logistic')) m(model)"


@query(
    "ml_train_gbt",
    oracle(
        "SELECT defaulted, count(*) AS n, true AS valid, true AS ranks FROM training GROUP BY 1",
        "defaulted n valid ranks", uses="training",
    ),
)
def _(spark, sf):
    """Rows for each class; whether all scores are probabilities and rank the classes on the
    rows of the fit better than a constant would."""
    rows, train, _ = _split(spark, sf)
    scored = _scores(_fits(train, ["boosted"]), rows, KEY, "defaulted", "role")
    fitted = scored.where("role = 'train'").select(F.col("defaulted").alias("y"), "p")
    ranks = metrics.metric_suite(fitted).select(F.coalesce(F.col("auc_roc") > 0.5, F.lit(False))).scalar()
    valid = F.coalesce(F.every(F.coalesce(F.col("p").between(0.0, 1.0), F.lit(False))), F.lit(False))
    return scored.groupBy("defaulted").agg(F.count("*").alias("n"), valid.alias("valid")).withColumn("ranks", ranks)


@query(
    "ml_train_logistic",
    oracle(
        " UNION ALL ".join(f"SELECT '{f}' AS feature, true AS flat" for f in [*ORDER, "(intercept)"]), "feature flat"
    ),
)
def _(spark, sf):
    """Whether the penalised, weighted loss is flat at the fitted coefficients."""
    _, train, _ = _split(spark, sf)
    train = cut_lineage(prep.with_class_weight(train, "defaulted"))
    model = models.fit(train.drop("weight"), "logistic", FEATURES)
    slopes = models.loss_slopes(model, train, "defaulted", "weight")
    return slopes.select("feature", (F.abs("slope") < 1e-4).alias("flat"))


@query("ml_cross_validate")
def _(spark, sf):
    """Rows, defaults and metrics of each fold, role and model; fold null: the means over the folds."""
    rows = ready(spark, sf)
    folds = prep.temporal_folds(rows.select(KEY, "application_date"))
    found = cut_lineage(models.cross_validate(rows, folds, MODELS, FEATURES, extra={"mean_p": F.avg("p")}))
    both = (F.col("n_defaulted") > 0) & (F.col("n_defaulted") < F.col("n_rows"))
    broken = F.col("brier_score").isNull() | (both & (F.col("auc_roc").isNull() | F.col("ks_statistic").isNull()))
    if found.where(broken | ((F.col("role") == "train") & ~(F.col("auc_roc") > 0.5))).count():
        raise ValueError("a fold without metrics, or a fit that does not rank its own rows")
    return found.unionByName(models.mean_over_folds(found).drop("n_folds"), allowMissingColumns=True)


@query("ml_score")
def _(spark, sf):
    """The probability of default of every company by both models, fitted on the training rows."""
    rows, train, _ = _split(spark, sf)
    return _scores(_checked(_fits(train), train), rows, KEY, "role")


@query("ml_refit_all")
def _(spark, sf):
    """(model, fitted_on, role, rows, metrics): hold-out numbers come from the fit on the training
    rows, and the delivered models are fitted again on all rows."""
    rows, train, _ = _split(spark, sf)
    label = F.col("defaulted").alias("y")
    wanted = {(m, on): (part, m, FEATURES) for m in MODELS for on, part in (("train", train), ("all", rows))}
    fitted = models.fit_side_by_side(wanted)
    scored = [_scores({m: model}, rows, KEY, "role", label).withColumn("fitted_on", F.lit(on)) for (m, on), model in fitted.items()]
    scored = cut_lineage(reduce(DataFrame.unionByName, scored))
    # Each fit is held to all rows that it was fitted on, and to no part of them.
    sound(scored.where("role = 'train' OR fitted_on = 'all'"), ["model", "fitted_on"])
    return metrics.grouped_metrics(scored, ["model", "fitted_on", "role"])


@query("ml_feature_importance")
def _(spark, sf):
    """The fifteen most important features of the delivered boosted model."""
    rows = ready(spark, sf)
    model = _checked(_fits(rows, ["boosted"]), rows)["boosted"]
    every = models.feature_importance(spark, model, top=None).agg(F.min("importance"), F.sum("importance"), F.count("*")).first()
    if every[0] < 0 or abs(every[1] - 1) > 1e-6 or every[2] != len(models.assembled_names(model)):
        raise ValueError(f"importances that are no shares: {every}")
    return models.feature_importance(spark, model, top=15)


@query(
    "ml_linear_explain",
    oracle(
        " UNION ALL ".join(
            f"SELECT company_id, '{f}' AS feature, {f} AS value, {(i + 1) / 10!r} AS coefficient, {f} * {(i + 1) / 10!r} AS contribution FROM scaled"
            for i, f in enumerate(ORDER)
        ),
        "company_id feature", "value coefficient contribution", uses="scaled",
    ),
)
def _(spark, sf):
    weights = spark.createDataFrame(
        [(f, (i + 1) / 10) for i, f in enumerate(ORDER)], "feature STRING, coefficient DOUBLE"
    )
    return models.linear_explanation(_scaled(spark, sf, ORDER), weights, ORDER)


@query(
    "save_model",
    oracle(f"SELECT company_id, model, true AS same FROM {_MODEL_ROWS}", "company_id model same", uses="training"),
)
def _(spark, sf):
    """Whether both models score every company alike after writing and reading them."""
    rows = ready(spark, sf)
    fitted, again = _checked(_fits(rows), rows), {}
    for name, model in fitted.items():
        path = work_folder(spark, f"model-{name}")
        models.save_model(model, path)
        again[name] = models.load_model(path)
    before = _scores(fitted, rows, KEY).withColumnRenamed("p", "p_before")
    after = _scores(again, rows, KEY).withColumnRenamed("p", "p_after")
    return before.join(after, [KEY, "model"]).select(KEY, "model", (F.col("p_before") == F.col("p_after")).alias("same"))
