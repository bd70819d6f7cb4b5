"""Model numbers against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.catalog import model_queries, registry
from creditloom.operators import metrics, models

FEATURES = ["supplier_hhi", "total_inflow"]


def plain_metrics(y, p):
    y, p = np.array(y, float), np.array(p, float)
    out = {"n_rows": len(y), "n_defaulted": int(y.sum()), "brier_score": float(((p - y) ** 2).mean())}
    bins = np.digitize(p, [i * 0.1 for i in range(1, 10)])
    out["ece"] = float(sum(abs((y - p)[bins == b].sum()) for b in set(bins)) / len(y))
    one, zero = p[y == 1], p[y == 0]
    if len(one) and len(zero):
        out["auc_roc"] = float(((one[:, None] > zero) + 0.5 * (one[:, None] == zero)).mean())
        cuts = np.unique(p)
        out["ks_statistic"] = float(max(abs((one <= c).mean() - (zero <= c).mean()) for c in cuts))
    return out


def test_grouped_metrics(spark):
    rng = random.Random(3)
    rows = [(g, int(rng.random() < 0.4), rng.choice([round(rng.random(), 2), 0.25, 1.0])) for g in "abc" for _ in range(200)]
    rows += [("one class", 1, 0.5), ("one class", 1, 0.7), ("null", None, 0.5), ("a", 1, None)]
    frame = spark.createDataFrame(rows, "g string, y int, p double")
    found = {r["g"]: r for r in metrics.grouped_metrics(frame, ["g"], extra={"top": F.max("p")}).collect()}
    assert set(found) == {"a", "b", "c", "one class"}
    for g, r in found.items():
        mine = [(y, p) for k, y, p in rows if k == g and p is not None]
        want = plain_metrics(*zip(*mine))
        assert all(r[k] == pytest.approx(v) for k, v in want.items()) and r["top"] == max(p for _, p in mine)
    assert found["one class"]["auc_roc"] is None
    one = metrics.metric_suite(frame.where("g = 'b'")).first()
    assert all(one[m] == pytest.approx(found["b"][m]) for m in ("auc_roc", "gini", "ks_statistic", "brier_score", "ece"))


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(2)
    rows = []
    for i in range(240):
        bad = int(rng.random() < 0.3)
        rows.append((i, bad, rng.gauss(2.0 * bad, 1), rng.gauss(-1.0 * bad, 1) if i % 9 else None))
    return spark.createDataFrame(rows, "company_id INT, defaulted INT, supplier_hhi DOUBLE, total_inflow DOUBLE").cache()


def test_folds_are_measured_on_their_own_rows(spark, data):
    folds = data.selectExpr("company_id", "explode(array(0, 1, 2)) AS fold").selectExpr(
        "fold", "company_id", "CASE WHEN company_id < 60 * (fold + 1) THEN 'train' WHEN company_id < 60 * (fold + 2) THEN 'test' END AS role"
    ).where("role IS NOT NULL")
    one_class = data.where("defaulted = 0").selectExpr("9 AS fold", "company_id", "'train' AS role")
    found = models.cross_validate(data, folds.unionByName(one_class), ["boosted", "logistic"], FEATURES, n_trees=4, extra={"mean_p": F.avg("p")})
    rows = {(r["fold"], r["role"], r["model"]): r for r in found.collect()}
    assert set(rows) == {(f, r, m) for f in range(3) for r in ("train", "test") for m in ("boosted", "logistic")}
    model = models.fit(data.where("company_id < 120"), "logistic", FEATURES)
    scores = models.score(model, data.where("company_id >= 120 AND company_id < 180"), [F.col("defaulted").alias("y")]).collect()
    for k, v in plain_metrics([r["y"] for r in scores], [r["p"] for r in scores]).items():
        assert rows[1, "test", "logistic"][k] == pytest.approx(v, abs=1e-9)
    assert rows[1, "test", "logistic"]["mean_p"] == pytest.approx(np.mean([r["p"] for r in scores]))
    means = {(r["model"], r["role"]): r for r in models.mean_over_folds(found).collect()}
    assert means["boosted", "test"]["auc_roc"] == pytest.approx(np.mean([rows[f, "test", "boosted"]["auc_roc"] for f in range(3)]))
    assert models.cross_validate(data, one_class, ["logistic"], FEATURES).collect() == []


def test_broken_scores_are_an_error(spark, data):
    good = data.select(F.lit("m").alias("model"), F.col("defaulted").alias("y"), (0.2 + 0.5 * F.col("defaulted")).alias("p"))
    assert model_queries.sound(good).count() == 240
    for p in (F.lit(0.5), F.lit(None).cast("double"), F.lit(1.5), 1 - F.col("p")):
        with pytest.raises(ValueError):
            model_queries.sound(good.withColumn("p", p))


def test_models_of_the_same_rows_share_their_preparation(spark, data, monkeypatch):
    """Both fits of a table, and both fits of a fold, use one set of fitted numbers; models stay those of single fits."""
    made = []
    scaling = models.prep.fit_scaling
    monkeypatch.setattr(models.prep, "fit_scaling", lambda df, features: made.append(1) or scaling(df, features))
    fitted = models.fit_side_by_side({m: (data, m, FEATURES) for m in ("boosted", "logistic")}, n_trees=3)
    assert len(made) == 1
    other = models.fit_side_by_side({"one": (data, "logistic", FEATURES), "less": (data, "logistic", FEATURES[:1])})
    assert len(made) == 3 and [len(models.assembled_names(other[k])) for k in ("one", "less")] == [2, 1]
    for kind in ("boosted", "logistic"):
        alone = models.score(models.fit(data, kind, FEATURES, n_trees=3), data, ["company_id"]).orderBy("company_id").collect()
        beside = models.score(fitted[kind], data, ["company_id"]).orderBy("company_id").collect()
        assert [r["p"] for r in beside] == pytest.approx([r["p"] for r in alone], abs=1e-9)


def test_split_makes_the_training_table_once(spark, data, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def seen(v):
        made.add(1)
        return v

    counted = data.withColumn("defaulted", F.udf(seen, "int")("defaulted"))
    monkeypatch.setattr(model_queries, "training", lambda spark, sf: counted)
    rows, train, test = model_queries._split(spark, "")
    assert train.count() + test.count() == rows.count() == 240 and made.value == 240


def test_refit_is_held_to_the_rows_of_its_own_fit(spark, monkeypatch):
    """A fit on all rows may rank some of them badly; a fit on the training rows has to rank these."""
    rows = [(i, i % 2, "train" if i < 40 else "test") for i in range(100)]
    rows = spark.createDataFrame(rows, "company_id INT, defaulted INT, role STRING")
    parts = rows, rows.where("role = 'train'"), rows.where("role = 'test'")
    y, trained = F.col("defaulted"), F.col("role") == "train"

    def refit(good):
        """Fits named in ``good`` rank all rows, others all but the training rows."""
        def scores(fitted, rows, *keep):
            (m, on), = fitted.items()
            p = 0.4 + 0.2 * y if on in good else F.when(trained, 0.6 - 0.2 * y).otherwise(0.3 + 0.4 * y)
            return rows.select(*keep, p.alias("p"), F.lit(m).alias("model"))

        monkeypatch.setattr(model_queries, "_split", lambda spark, sf: parts)
        monkeypatch.setattr(models, "fit_side_by_side", lambda wanted: {k: k[1] for k in wanted})
        monkeypatch.setattr(model_queries, "_scores", scores)
        return registry.QUERIES["ml_refit_all"](spark, "").count()

    assert refit({"train"}) == 8
    with pytest.raises(ValueError):
        refit({"all"})
