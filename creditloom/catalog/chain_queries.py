"""One chain through all families: names, features, both models, decisions and drivers."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog.feature_queries import training
from creditloom.catalog.name_queries import resolved
from creditloom.catalog.registry import oracle, query
from creditloom.catalog.score_queries import FEATURES
from creditloom.operators import decisions, models, prep
from creditloom.session import cut_lineage

KEY = "company_id"
TOP = 5


def decided_companies(spark, sf):
    """(company_id, p, p_shadow, supplier_hhi, decision, confidence, needs_review, drivers).

    The mapping of the resolver feeds the features; the models are fitted on the training rows
    of the split and score every company; the drivers, an array by position, use the
    importances of the boosted model.
    """
    mapping = cut_lineage(resolved(spark, sf))
    rows = cut_lineage(training(spark, sf, mapping))
    rows = cut_lineage(prep.stratified_split(rows, "defaulted", KEY))
    train = rows.where("role = 'train'")
    fitted = models.fit_side_by_side({m: (train, m, FEATURES) for m in ("boosted", "logistic")})
    boosted, logistic = fitted["boosted"], fitted["logistic"]
    primary = cut_lineage(models.score(boosted, rows, [KEY, "supplier_hhi"]))
    shadow = models.score(logistic, rows, [KEY])
    review = decisions.shadow_review(primary, shadow, KEY).select(KEY, "p_shadow", "needs_review")
    drivers = decisions.top_drivers(rows, models.feature_importance(spark, boosted, top=None), FEATURES, TOP)
    entry = F.struct("position", "feature", "contribution", "impact")
    lists = drivers.groupBy(KEY).agg(F.array_sort(F.collect_list(entry)).alias("drivers"))
    return decisions.decide(primary).join(review, KEY).join(lists, KEY)


@query(
    "dc_chain",
    oracle(
        f"SELECT company_id, true AS scored, true AS decided, {TOP} AS n_drivers, true AS ranked FROM companies",
        "company_id scored decided n_drivers ranked", uses="companies",
    ),
)
def _(spark, sf):
    """Whether scores are probabilities, decisions follow the bands and the gap of the two
    models, and drivers fall by contribution, for every company."""
    p, gap = F.col("p"), F.abs(F.col("p") - F.col("p_shadow"))
    band = F.when(p < 0.08, "APPROVE").when(p < 0.15, "REVIEW").otherwise("DECLINE")
    share = F.coalesce(F.col("supplier_hhi").between(0.0, 1.0), F.lit(True))
    sizes = F.transform("drivers", lambda d: d["contribution"])
    return decided_companies(spark, sf).select(
        KEY,
        (p.between(0.0, 1.0) & F.col("p_shadow").between(0.0, 1.0) & share).alias("scored"),
        ((F.col("decision") == band) & (F.col("needs_review") == (gap > 0.2))).alias("decided"),
        F.size("drivers").alias("n_drivers"),
        (sizes == F.sort_array(sizes, asc=False)).alias("ranked"),
    )
