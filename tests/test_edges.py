"""Hand-computed edge cases on literal rows."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from creditloom.functions.names import normalise_name
from creditloom.operators import alt_features, clustering, decisions, fuzzy, metrics, prep, resolution, resolution_eval, store
from creditloom.operators import txn_features as txn
from creditloom.plans.components import connected_components
from creditloom.plans.ranks import exact_quantiles, row_positions, running_totals

DAY = dt.date(2023, 6, 30)


def transactions(spark, rows):
    data = [(c, d, Decimal(str(a)), m) for c, d, a, m in rows]
    return spark.createDataFrame(data, "company_id STRING, transaction_date DATE, amount DECIMAL(18,2), merchant_name STRING")


def days_before(n):
    return DAY - dt.timedelta(days=n)


def vector(spark, rows):
    found = txn.stability_vector(transactions(spark, rows), str(DAY)).collect()
    return {r["company_id"]: r for r in found}


@pytest.fixture(scope="module")
def vectors(spark):
    rows = []
    rows += [("nine", days_before(i), 10, "A") for i in range(9)]
    rows += [("ten", days_before(i), 10, "A") for i in range(10)]
    rows += [("one_month", days_before(i % 12), 5 if i % 2 else -5, "A") for i in range(12)]
    rows += [("inflow_only", days_before(40 * i), 10, f"P{i}") for i in range(12)]
    rows += [("outflow_only", days_before(40 * i), -10, "P") for i in range(12)]
    rows += [("net_zero", days_before(10), a, "P") for a in (5, -5)] + [("net_zero", days_before(85 + i), 1, "P") for i in range(12)]
    rows += [("edge_90", days_before(90), 7, "P")] + [("edge_90", days_before(200 + i), 7, "P") for i in range(12)]
    rows += [("silent", days_before(200 + i), 7, "P") for i in range(12)]
    rows += [("future", days_before(i), 10, "A") for i in range(10)] + [("future", days_before(-5), 999, "A")]
    return vector(spark, rows)


def test_minimum_history(vectors):
    assert all(vectors["nine"][f] is None for f in txn.FEATURES)
    assert vectors["ten"]["txn_count_90d"] == 10 and vectors["ten"]["active_days_ratio"] == pytest.approx(10 / 9)


def test_single_month(vectors):
    assert vectors["one_month"]["cv_monthly_net"] is None
    assert vectors["one_month"]["txn_frequency_trend"] is None
    assert vectors["one_month"]["net_operating_ratio"] == 1.0


def test_one_sided(vectors):
    assert vectors["inflow_only"]["net_operating_ratio"] is None
    assert vectors["inflow_only"]["supplier_hhi"] is None and vectors["inflow_only"]["months_runway"] is None
    assert vectors["inflow_only"]["recurring_revenue_ratio"] == pytest.approx(0.25)
    assert vectors["outflow_only"]["supplier_hhi"] == 1.0
    assert vectors["outflow_only"]["recurring_revenue_ratio"] is None


def test_quiet_streak(vectors):
    # busy days are 85..89 days back; the day with +5 and -5 counts as quiet
    assert vectors["net_zero"]["max_zero_day_streak_90d"] == 85
    assert vectors["edge_90"]["max_zero_day_streak_90d"] == 90
    assert vectors["silent"]["max_zero_day_streak_90d"] == 90


def test_later_rows_change_nothing(vectors):
    assert vectors["future"][2:] == vectors["ten"][2:]


def test_streak_against_calendar(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for c in range(30):
        offsets = sorted({rng.randrange(0, 120) for _ in range(rng.randrange(12, 40))})
        rows += [(f"c{c}", days_before(o), rng.choice([-3, 4]), "x") for o in offsets]
        quiet = [o not in offsets for o in range(90)]
        expected[f"c{c}"] = max((len(list(g)) for k, g in itertools.groupby(quiet) if k), default=0)
    got = {k: r["max_zero_day_streak_90d"] for k, r in vector(spark, rows).items() if r["txn_count_180d"] is not None}
    assert got == {k: expected[k] for k in got} and len(got) > 20


def test_spine_of_dates(spark):
    rows = transactions(spark, [("a", days_before(i), 10, "A") for i in range(20)])
    spine = spark.createDataFrame([("a", DAY), ("a", days_before(5)), ("b", DAY)], "company_id STRING, as_of_date DATE")
    got = {(r["company_id"], r["as_of_date"]): r["txn_count_90d"] for r in txn.stability_vector(rows, spine).collect()}
    assert got == {("a", DAY): 20, ("a", days_before(5)): 15, ("b", DAY): None}


def test_normalise(spark):
    cases = {
        "SQ *ACME": "ACME", "Acme Ltd.": "ACME", "acme uk ltd": "ACME", "Acme Store 99": "ACME", "ACME #12": "ACME",
        "Acme Retail": "ACME", "ACME.CO.UK": "ACMECO", "  acme\t": "ACME", "ACME *PAY.COM": "ACME",
        "GOOGLE *SERVICES": "", "": "", "Acme's & Sons": "ACMES SONS", " Acme Ltd": "ACME",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()] + [(None, "")], "raw STRING, want STRING")
    bad = df.withColumn("got", normalise_name(F.col("raw"))).where("got <> want").collect()
    assert not bad


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def ratio(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 100.0 if not a + b else 200.0 * lcs(a, b) / (len(a) + len(b))


def words(rng, n, longest=12):
    return ["".join(rng.choice("ABCDE 12") for _ in range(rng.randrange(2, longest))).strip() or "AA" for _ in range(n)]


def test_similarity_and_best_match(spark):
    rng = random.Random(7)
    names = sorted(set(words(rng, 60) + ["AB " * 30 + "C", "ABC" * 30]))
    entries = sorted(set(words(rng, 40) + ["AB " * 31, "ABD" * 29]))
    dictionary = spark.createDataFrame([(e, i) for i, e in enumerate(entries)], "entry STRING, entry_rank INT")
    got = fuzzy.fuzzy_match(spark.createDataFrame([(n,) for n in names], "name STRING"), dictionary, 70.0).collect()
    assert len(got) == len(names)
    for row in got:
        scores = [ratio(row["name"], e) for e in entries]
        best = max(scores) if len(row["name"]) >= 2 else 0.0
        assert row["accepted"] == (best >= 70)
        if best >= 70:
            assert row["score"] == pytest.approx(best)
            assert row["match"] == entries[scores.index(max(scores))]
        else:
            assert row["match"] == row["name"] and row["score"] is None


def test_hot_and_null_names_keep_their_rows(spark):
    rows = [(i, ["A", "B", None, "C"][i % 4]) for i in range(80)]
    mapping = spark.createDataFrame([("A", "one"), ("C", None), ("Z", "no")], "raw STRING, canonical STRING")
    got = resolution.apply_mapping(spark.createDataFrame(rows, "id INT, merchant_name STRING"), mapping, hot_rows=3, parts=5)
    want = {(i, n, {"A": "one"}.get(n, n)) for i, n in rows}
    assert {tuple(r) for r in got.collect()} == want and got.count() == 80


def test_clusters_against_brute_force(spark):
    rng = random.Random(11)
    names = sorted({n for n in words(rng, 80, 10) if len(n.strip()) > 1} | {"PAYER ONE", "PAYER ONE A", "PAYER ONE B", "PAYER ONE AB"})
    df = spark.createDataFrame([(n, 1) for n in names], "name STRING, copies BIGINT")
    weights = {}
    for r in clustering.tfidf(df).collect():
        weights.setdefault(r["name"], {})[r["gram"]] = r["weight"]
    want = {
        (a, b)
        for a, b in itertools.combinations(names, 2)
        if sum(w * weights[b].get(g, 0.0) for g, w in weights[a].items()) >= 0.7 - 1e-9
    }
    got = {(r["name_a"], r["name_b"]) for r in clustering.cosine_pairs(df, 0.3).collect()}
    assert got == want and want


def test_split_posting_lists(spark, monkeypatch):
    df = spark.createDataFrame([(f"PAYER {i}", 1) for i in range(60)], "name STRING, copies BIGINT")
    whole = {(r[0], r[1]) for r in clustering.cosine_pairs(df, 0.5).collect()}
    clusters = sorted(tuple(r) for r in clustering.cluster_names(df, 0.5).collect())
    monkeypatch.setattr(clustering, "CELL", 7)
    assert sorted(tuple(r) for r in clustering.cluster_names(df, 0.5).collect()) == clusters and clusters
    assert {(r[0], r[1]) for r in clustering.cosine_pairs(df, 0.5).collect()} == whole and whole


def test_lone_and_duplicate_unknowns(spark):
    one = spark.createDataFrame([("ONLY", 1)], "name STRING, copies BIGINT")
    assert [tuple(r) for r in clustering.cluster_names(one).collect()] == [("ONLY", "ONLY")]
    two = spark.createDataFrame([("TWICE", 2), ("OTHERS", 1)], "name STRING, copies BIGINT")
    assert [tuple(r) for r in clustering.cluster_names(two).collect()] == [("TWICE", "TWICE")]


def test_cascade_order(spark):
    names = spark.createDataFrame([("Amzn Mktp",), ("AMAZON.CO.UK",), ("Zzyzx",), (None,)], "raw STRING")
    resolved = resolution.resolve_names(
        names, resolution.curated_dictionary(spark), resolution.curated_overrides(spark)
    )
    got = {r["raw"]: (r["canonical"], r["method"]) for r in resolved.collect()}
    assert got["Amzn Mktp"] == ("AMAZON", "manual") and got["AMAZON.CO.UK"] == ("AMAZON", "fuzzy")
    assert got[None][0] == "" and got["Zzyzx"] == ("ZZYZX", "clustered")


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u BIGINT, v BIGINT")).collect()}
    assert set(got.values()) == {1, 100} and len(got) == 70


def test_no_truth(spark):
    mapping = spark.createDataFrame([("a", "A", "A", "fuzzy")], "raw STRING, normalised STRING, canonical STRING, method STRING")
    truth = spark.createDataFrame([("b", "B")], "raw_name STRING, true_canonical STRING")
    row = resolution_eval.evaluate(mapping, truth).first()
    assert (row["overall_accuracy"], row["n_evaluated"], row["coverage"]) == (0.0, 0, 0.0)


def test_review_counts(spark):
    rows = [(f"n{n}", DAY - dt.timedelta(days=10 * (n - i)), 0.1 * i) for n in (2, 3, 5, 6) for i in range(n)]
    reviews = spark.createDataFrame(rows, "company_id STRING, review_date DATE, sentiment_score DOUBLE")
    got = {r["company_id"]: r for r in alt_features.sentiment_features(reviews, str(DAY)).collect()}
    assert got["n2"]["google_sentiment_mean"] is None and got["n2"]["google_sentiment_trend"] is None
    assert got["n3"]["google_sentiment_trend"] == 0.0 and got["n5"]["google_sentiment_trend"] == 0.0
    assert got["n6"]["google_sentiment_trend"] == pytest.approx(0.1)
    assert got["n3"]["google_review_velocity"] == pytest.approx(1.0)


def test_headcount_counts(spark):
    rows = [(f"n{n}", DAY - dt.timedelta(days=30 * (n - i)), 10 + i) for n in (1, 2, 3, 4) for i in range(n)]
    heads = spark.createDataFrame(rows, "company_id STRING, scrape_date DATE, headcount_estimate INT")
    got = {r["company_id"]: (r["headcount_growth_rate"], r["headcount_latest"]) for r in alt_features.headcount_features(heads, str(DAY)).collect()}
    assert got["n1"] == (None, None) and got["n2"] == (None, 11) and got["n3"] == (None, 12)
    assert got["n4"][0] == pytest.approx(1 / 11.5) and got["n4"][1] == 13


def test_leading_zero_area_and_vacancy_counts(spark):
    companies = spark.createDataFrame([("a", "09A1 1AA"), ("b", "10B2"), ("c", "77"), ("d", None)], "company_id STRING, postcode STRING")
    rows = [("09", dt.date(2023, m, 1), 0.1 * m) for m in range(1, 7)] + [("10", dt.date(2023, m, 1), 0.1 * m) for m in range(1, 6)]
    vacancy = spark.createDataFrame(rows, "postcode_area STRING, date DATE, vacancy_rate DOUBLE")
    got = {r["company_id"]: r for r in alt_features.vacancy_features(companies, vacancy, str(DAY)).collect()}
    assert got["a"]["local_vacancy_rate"] == pytest.approx(0.6) and got["a"]["local_vacancy_trend"] == pytest.approx(0.1)
    assert got["b"]["local_vacancy_trend"] == 0.0
    assert got["c"]["local_vacancy_rate"] is None and got["d"]["local_vacancy_trend"] is None


def test_store_versions(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "company_id STRING, feature_date DATE, features_json STRING, created_at TIMESTAMP"
    day, later = dt.date(2023, 1, 1), dt.date(2023, 2, 1)
    write = lambda rows: store.upsert(spark, path, spark.createDataFrame(rows, schema))
    write([("a", day, '{"x":1.0}', dt.datetime(2023, 3, 1)), ("a", later, '{"x":5.0}', dt.datetime(2023, 3, 1))])
    write([("a", day, '{"x":2.0}', dt.datetime(2023, 3, 2))])
    rows = store.decode_json(store.read_store(spark, path), ["x"])
    assert {(r["feature_date"], r["x"]) for r in rows.collect()} == {(day, 2.0), (later, 5.0)}
    asked = spark.createDataFrame([("a", dt.date(2023, 1, 15)), ("a", dt.date(2022, 1, 1)), ("a", later)], "company_id STRING, as_of_date DATE")
    got = {r["as_of_date"]: r["x"] for r in store.lookup_as_of(asked, rows, ["x"]).collect()}
    assert got == {dt.date(2023, 1, 15): 2.0, dt.date(2022, 1, 1): None, later: 5.0}


def test_json_has_no_nan(spark):
    df = spark.createDataFrame([("a", float("nan"), 2.0)], "company_id STRING, x DOUBLE, y DOUBLE")
    assert store.encode_json(df, ["x", "y"]).first()["features_json"] == '{"x":null,"y":2.0}'


def scores(spark, rows):
    return spark.createDataFrame(rows, "y INT, p DOUBLE")


def test_tied_and_one_class_scores(spark):
    tied = metrics.rank_metrics(scores(spark, [(0, 0.5), (1, 0.5), (1, 0.5)])).first()
    assert tied["auc_roc"] == 0.5 and tied["ks_statistic"] == 0.0
    assert metrics.rank_metrics(scores(spark, [(1, 0.2), (1, 0.9)])).first()["ks_statistic"] == 0.0


def test_bin_edges(spark):
    rows = scores(spark, [(0, 0.0), (0, 0.1), (1, 0.3), (0, 0.5), (1, 1.0)])
    assert {r["bin"] for r in metrics.calibration_curve(rows).collect()} == {0, 2, 4, 9}
    # 0.3 is below the third edge, 3 * 0.1 in doubles
    assert metrics.calibration_error(rows).first()["ece"] == pytest.approx((0 + 0.1 + 0.7 + 0.5 + 0) / 5)


def test_deciles_with_ties(spark):
    rows = scores(spark, [(i % 2, 0.1 * (i % 3)) for i in range(90)])
    got = sorted((r["decile"], r["count"]) for r in metrics.decile_table(rows).collect())
    assert sum(n for _, n in got) == 90 and len(got) <= 3


def test_decision_edges(spark):
    rows = spark.createDataFrame([(0.0799,), (0.08,), (0.1499,), (0.15,)], "p DOUBLE")
    assert [r["decision"] for r in decisions.decide(rows).orderBy("p").collect()] == ["APPROVE", "REVIEW", "REVIEW", "DECLINE"]


@pytest.mark.parametrize("n, folds, first", [(300, 4, 60), (302, 5, 2), (299, 5, 4)])
def test_fold_sizes(spark, n, folds, first):
    df = spark.range(n).select(F.col("id").alias("company_id"), F.lit(DAY).alias("application_date"))
    got = prep.temporal_folds(df).groupBy("fold", "role").count().collect()
    numbers = {r["fold"] for r in got}
    assert len(numbers) == folds
    assert next(r["count"] for r in got if r["fold"] == min(numbers) and r["role"] == "train") == first


def test_order_statistics_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    values = np.round(rng.lognormal(3, 2, 3000), 2).tolist() + [1.0] * 1500
    df = spark.createDataFrame([("hot", v) for v in values] + [("cold", -3.5)], "g STRING, v DOUBLE")
    probabilities = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "v", probabilities, ["g"]).collect()}
    assert got["hot"] == pytest.approx(np.quantile(values, probabilities).tolist())
    assert got["cold"] == [-3.5] * 5
    counts = df.where("g = 'hot'").groupBy("v").agg(F.count("*").alias("n"))
    rows = sorted((r["v"], r["n"], r["cum_n"], r["prev_n"]) for r in running_totals(counts, "v", ["n"], previous=True).collect())
    total, before = 0, None
    for _, n, cumulated, previous in rows:
        total += n
        assert cumulated == total and previous == before
        before = n
    at = row_positions(spark.range(100).withColumn("b", F.floor(F.col("id") / 7)), ["id"], ["b"])
    assert all(r["position"] == r["id"] + 1 for r in at.collect())


def test_scaling_rules(spark):
    rows = [(i, float(i), 5.0, None if i % 2 else 1.0 * i) for i in range(8)]
    df = spark.createDataFrame(rows, "company_id INT, supplier_hhi DOUBLE, total_inflow DOUBLE, total_outflow DOUBLE")
    features = ["supplier_hhi", "total_inflow", "total_outflow"]
    fitted = prep.fitted_rows(prep.fit_scaling(df, features))
    assert fitted["supplier_hhi"] == pytest.approx((3.5, 3.5, 3.5))
    assert fitted["total_inflow"] == (5.0, 5.0, 1.0)
    assert fitted["total_outflow"][0] == 3.0
    assert prep.available_features(df.withColumn("share_capital", F.lit(None).cast("double"))) == [
        "supplier_hhi", "total_inflow", "total_outflow"
    ]


def test_unknown_model_type():
    from creditloom.operators.models import estimator

    with pytest.raises(ValueError):
        estimator("forest", 10)


def test_models_rank_and_reload(spark, tmp_path):
    from creditloom.operators import models

    rng = random.Random(2)
    rows = []
    for i in range(300):
        bad = int(rng.random() < 0.3)
        rows.append((i, bad, rng.gauss(2.0 * bad, 1), rng.gauss(-1.0 * bad, 1) if i % 9 else None))
    df = spark.createDataFrame(rows, "company_id INT, defaulted INT, supplier_hhi DOUBLE, total_inflow DOUBLE").cache()
    for kind in ("boosted", "logistic"):
        model = models.fit(df, kind, ["supplier_hhi", "total_inflow"], n_trees=5)
        assert models.evaluate(model, df).first()["auc_roc"] > 0.85
        path = str(tmp_path / kind)
        models.save_model(model, path)
        again = models.score(models.load_model(path), df, ["company_id"])
        gap = models.score(model, df, ["company_id"]).join(again.withColumnRenamed("p", "q"), "company_id")
        assert gap.where("abs(p - q) > 1e-12").count() == 0
    boosted = models.fit(df, "boosted", ["supplier_hhi", "total_inflow"], n_trees=5)
    assert models.feature_importance(spark, boosted).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_signatures_find_near_pairs(spark, monkeypatch):
    rng = random.Random(12)
    bases = words(rng, 60, 14)
    names = sorted({b + rng.choice(["", "A", "B1", " C"]) for b in bases for _ in range(4)} | {"PAYER ONE", "PAYER ONE A", "PAYER ONE B"})
    df = spark.createDataFrame([(n, 1) for n in names if len(n) > 1], "name STRING, copies BIGINT")
    exact = {(r[0], r[1]): r[2] for r in clustering.cosine_pairs(df, 0.3).collect()}
    found = clustering.approximate_pairs(df, 0.3)
    got = {(r[0], r[1]): r[2] for r in found.collect()}
    assert got.keys() <= exact.keys() and len(got) >= 0.9 * len(exact) > 50
    assert all(got[k] == pytest.approx(exact[k]) for k in got)
    row = clustering.recall_of(found, clustering.cosine_pairs(df, 0.3)).first()
    assert (row["n_exact"], row["n_found"]) == (len(exact), len(got))
    monkeypatch.setattr(clustering, "CELL", 3)
    assert {(r[0], r[1]) for r in clustering.approximate_pairs(df, 0.3).collect()} == got.keys()
    assert clustering.approximate_pairs(df.limit(0)).collect() == []
