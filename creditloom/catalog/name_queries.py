"""Queries over counterparty names: cleaning, matching, clustering, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog.fixtures import cte, duck_normalise, duck_rules, view
from creditloom.catalog.registry import oracle, query
from creditloom.functions import names as nm
from creditloom.operators import clustering, fuzzy, resolution, resolution_eval
from creditloom.session import cut_lineage

THRESHOLD, EPS = 70.0, 0.3


def names_of(spark, sf):
    return resolution.name_counts(view(spark, sf, "transactions"))


def distinct_forms(spark, sf):
    """(normalised, copies); the distinct raw names are written first, so no row is cleaned twice."""
    named = resolution.normalise_names(cut_lineage(names_of(spark, sf)))
    return named.groupBy("normalised").agg(F.count("*").alias("copies"))


# --- cleaning ---------------------------------------------------------------------------
query("er_normalise", oracle("SELECT raw, normalised FROM normed", "raw normalised", uses="normed"))(
    lambda spark, sf: resolution.normalise_names(names_of(spark, sf)).select("raw", "normalised")
)

_STAGES = {
    "er_strip_processor": (nm.strip_processor, nm.PROCESSOR_RULES, "gi"),
    "er_strip_codes": (nm.strip_codes, nm.CODE_RULES, "gi"),
    "er_strip_urls": (nm.strip_urls, nm.URL_RULES, "gi"),
    "er_strip_descriptors": (nm.strip_descriptors, nm.DESCRIPTOR_RULES, "gi"),
    "er_strip_legal": (nm.strip_legal, nm.LEGAL_RULES, "gi"),
    "er_clean_punct": (nm.clean_punctuation, nm.PUNCTUATION_RULES, "g"),
}


def _stage_query(key, step, rules, flags):
    text = duck_rules(duck_normalise("raw", "upper"), rules, flags)

    def run(spark, sf):
        return names_of(spark, sf).select("raw", step(nm.upper_stripped(F.col("raw"))).alias("stripped"))

    query(key, oracle(f"SELECT raw, {text} AS stripped FROM names", "raw stripped", uses="names"))(run)


for _key, (_step, _rules, _flags) in _STAGES.items():
    _stage_query(_key, _step, _rules, _flags)


# --- dictionaries -----------------------------------------------------------------------
query("er_name_counts", oracle("SELECT raw, n FROM names", "raw n", uses="names"))(names_of)


@query(
    "er_build_dictionary",
    oracle(
        "SELECT normalised AS entry, CAST(sum(n) AS BIGINT) AS frequency FROM normed WHERE normalised <> '' "
        "GROUP BY 1 HAVING sum(n) >= 3",
        "entry frequency", uses="normed",
    ),
)
def _(spark, sf):
    return resolution.build_dictionary(names_of(spark, sf), 3)


@query(
    "er_build_dictionary_weighted",
    oracle(
        "SELECT normalised AS entry, CAST(sum(n) AS BIGINT) AS frequency FROM normed WHERE normalised <> '' "
        "GROUP BY 1 HAVING sum(n) >= 300",
        "entry frequency", uses="normed",
    ),
)
def _(spark, sf):
    ranked = resolution.ranked_dictionary(resolution.build_dictionary(names_of(spark, sf), 300))
    return ranked.orderBy("entry_rank").select("entry", "frequency")


_CURATED = ", ".join(f"('{n}', {i})" for i, n in enumerate(resolution.CURATED_NAMES, 1))


@query(
    "er_static_dictionary",
    oracle(
        f"SELECT c.entry, CAST(c.entry_rank AS INT) AS entry_rank, CAST(coalesce(sum(m.n), 0) AS BIGINT) AS n_transactions "
        f"FROM (VALUES {_CURATED}) c(entry, entry_rank) LEFT JOIN normed m ON m.normalised = c.entry GROUP BY 1, 2",
        "entry entry_rank n_transactions", uses="normed",
    ),
)
def _(spark, sf):
    used = resolution.normalise_names(names_of(spark, sf)).groupBy(F.col("normalised").alias("entry")).agg(
        F.sum("n").alias("n")
    )
    return resolution.curated_dictionary(spark).join(used, "entry", "left").select(
        "entry", "entry_rank", F.coalesce("n", F.lit(0)).alias("n_transactions")
    )


_DIRTY = "CASE WHEN length(raw) % 5 = 0 THEN NULL WHEN length(raw) % 7 = 0 THEN '  ' ELSE raw END"


@query(
    "er_sanitise_dictionary",
    oracle(f"SELECT entry FROM (SELECT {_DIRTY} AS entry FROM names) d WHERE trim(entry) <> ''", "entry", uses="names"),
)
def _(spark, sf):
    return resolution.sanitise_dictionary(names_of(spark, sf).select(F.expr(_DIRTY).alias("entry")))


@query(
    "er_manual_lookup",
    oracle(
        "SELECT m.raw, m.normalised, o.canonical, 'manual' AS method, 100.0 AS score "
        "FROM normed m JOIN overrides o ON m.normalised = o.normalised",
        "raw normalised canonical method", "score", uses="normed overrides",
    ),
)
def _(spark, sf):
    named = resolution.normalise_names(names_of(spark, sf)).select("raw", "normalised")
    return resolution.apply_overrides(named, view(spark, sf, "overrides")).select(
        "raw", "normalised", "canonical", "method", "score"
    )


# --- similarity -------------------------------------------------------------------------
_SORTED = "array_to_string(list_sort(list_filter(string_split({0}, ' '), lambda t: t <> '')), ' ')"


def lcs_tables(source: str, prefix: str):
    """Recursive tables: ``{prefix}_score`` (a, b, score) for the texts of ``source`` (a, b)."""
    pairs = (
        f"SELECT DISTINCT {_SORTED.format('a')} AS sa, {_SORTED.format('b')} AS sb FROM {source}"
    )
    step = (
        "list_reduce(list_transform(range(1, length(sb) + 1), lambda j: [CAST(j AS INT)]), "
        "lambda acc, x: list_append(acc, CASE WHEN substr(sb, x[1], 1) = substr(sa, i + 1, 1) THEN line[x[1]] + 1 "
        "ELSE greatest(line[x[1] + 1], acc[-1]) END), [0])"
    )
    rows = (
        f"SELECT sa, sb, 0 AS i, list_transform(range(0, length(sb) + 1), lambda j: 0) AS line FROM {prefix}_pairs\n"
        f"UNION ALL SELECT sa, sb, i + 1, {step} FROM {prefix}_rows WHERE i < length(sa) AND length(sb) > 0"
    )
    score = (
        "SELECT sa, sb, CASE WHEN length(sa) + length(sb) = 0 THEN 100.0 "
        "ELSE 200.0 * line[-1] / (length(sa) + length(sb)) END AS score "
        f"FROM {prefix}_rows WHERE i = length(sa) OR length(sb) = 0"
    )
    return [(f"{prefix}_pairs", pairs), (f"{prefix}_rows", rows), (f"{prefix}_score", score)]


@query(
    "er_token_sort_ratio",
    oracle(
        f"SELECT n.raw, n.normalised, s.score FROM normed n JOIN raw_score s "
        f"ON s.sa = {_SORTED.format('upper(n.raw)')} AND s.sb = {_SORTED.format('n.normalised')}",
        "raw normalised", "score", uses="normed",
        extra=[("raw_source", "SELECT upper(raw) AS a, normalised AS b FROM normed"), *lcs_tables("raw_source", "raw")],
    ),
)
def _(spark, sf):
    named = cut_lineage(resolution.normalise_names(names_of(spark, sf)))
    ratio = fuzzy.token_sort_ratio(F.upper("raw"), F.col("normalised"))
    return named.select("raw", "normalised", ratio.alias("score"))


cte("forms", "normed", "SELECT normalised, count(*) AS copies FROM normed GROUP BY 1")
_MATCH_TABLES = [
    ("open_forms", "SELECT f.* FROM forms f WHERE f.normalised NOT IN (SELECT normalised FROM overrides)"),
    (
        "fz_source",
        "SELECT f.normalised AS a, d.entry AS b FROM {0} f CROSS JOIN dictionary d WHERE length(f.normalised) >= 2",
    ),
    *lcs_tables("fz_source", "fz"),
    (
        "fz_best",
        f"SELECT f.normalised, arg_min(d.entry, (-s.score, d.entry_rank)) AS entry, max(s.score) AS score "
        f"FROM {{0}} f CROSS JOIN dictionary d JOIN fz_score s ON s.sa = {_SORTED.format('f.normalised')} "
        f"AND s.sb = {_SORTED.format('d.entry')} WHERE length(f.normalised) >= 2 GROUP BY 1",
    ),
]


def match_tables(source):
    return [(n, t.replace("{0}", source)) for n, t in _MATCH_TABLES]


@query(
    "er_fuzzy_match",
    oracle(
        f"SELECT f.normalised AS name, CASE WHEN b.score >= {THRESHOLD} THEN b.entry ELSE f.normalised END AS match, "
        f"CASE WHEN b.score >= {THRESHOLD} THEN b.score END AS score, coalesce(b.score, 0) >= {THRESHOLD} AS accepted "
        "FROM forms f LEFT JOIN fz_best b ON f.normalised = b.normalised",
        "name match accepted", "score", uses="forms overrides dictionary", extra=match_tables("forms"),
    ),
)
def _(spark, sf):
    forms = distinct_forms(spark, sf).select(F.col("normalised").alias("name"))
    return fuzzy.fuzzy_match(cut_lineage(forms), cut_lineage(view(spark, sf, "dictionary")), THRESHOLD)


# --- clustering -------------------------------------------------------------------------
def cluster_tables(source: str, prefix: str):
    """Tables up to ``{prefix}_clusters`` (name, exemplar) for ``source`` (name, copies)."""
    p = prefix
    return [
        (f"{p}_named", f"SELECT name, copies FROM {source} WHERE length(trim(name)) > 1"),
        (
            f"{p}_tf",
            f"SELECT name, copies, gram, count(*) AS tf FROM (SELECT name, copies, k.k AS k, "
            f"unnest(list_transform(range(1, length(name) - k.k + 2), lambda i: substr(lower(name), i, k.k))) AS gram "
            f"FROM {p}_named CROSS JOIN (VALUES (2), (3), (4)) k(k) WHERE length(name) >= k.k) g GROUP BY 1, 2, 3",
        ),
        (f"{p}_df", f"SELECT gram, sum(copies) AS df FROM {p}_tf GROUP BY 1"),
        (
            f"{p}_raw",
            f"SELECT t.name, t.gram, d.df, t.tf * (ln((1.0 + (SELECT sum(copies) FROM {p}_named)) / (1.0 + d.df)) + 1) AS w "
            f"FROM {p}_tf t JOIN {p}_df d ON t.gram = d.gram",
        ),
        (
            f"{p}_weights",
            f"SELECT name, gram, CAST(df AS BIGINT) AS df, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS weight FROM {p}_raw",
        ),
        (
            f"{p}_cos",
            f"SELECT x.name AS name_a, y.name AS name_b, sum(x.weight * y.weight) AS cosine FROM {p}_weights x "
            f"JOIN {p}_weights y ON x.gram = y.gram AND x.name < y.name GROUP BY 1, 2 "
            f"HAVING sum(x.weight * y.weight) >= {1 - EPS} - 1e-9",
        ),
        (
            f"{p}_edges",
            f"SELECT name_a AS u, name_b AS v FROM {p}_cos UNION SELECT name_b, name_a FROM {p}_cos "
            f"UNION SELECT name_a, name_a FROM {p}_cos UNION SELECT name_b, name_b FROM {p}_cos",
        ),
        (
            f"{p}_reach",
            f"SELECT u, v FROM {p}_edges UNION SELECT r.u, e.v FROM {p}_reach r JOIN {p}_edges e ON r.v = e.u",
        ),
        (f"{p}_comp", f"SELECT u AS name, min(v) AS component FROM {p}_reach GROUP BY 1"),
        (
            f"{p}_clusters",
            f"SELECT c.name, arg_min(d.name, (length(d.name), d.name)) AS exemplar FROM {p}_comp c "
            f"JOIN {p}_comp d ON c.component = d.component GROUP BY 1 UNION ALL "
            f"SELECT name, name FROM {p}_named WHERE name NOT IN (SELECT name FROM {p}_comp) "
            f"AND (copies > 1 OR (SELECT sum(copies) FROM {p}_named) = 1)",
        ),
    ]


# Names without an equal dictionary entry or override: the input of the clustering queries.
cte(
    "loose",
    "forms overrides dictionary",
    "SELECT normalised AS name, copies FROM forms WHERE normalised NOT IN (SELECT normalised FROM overrides) "
    "AND normalised NOT IN (SELECT entry FROM dictionary)",
)


def loose_names(spark, sf):
    forms = distinct_forms(spark, sf).withColumnRenamed("normalised", "name")
    known = view(spark, sf, "overrides").select(F.col("normalised").alias("name")).union(
        view(spark, sf, "dictionary").select("entry")
    )
    return cut_lineage(forms.join(known, "name", "left_anti"))


_LOOSE = cluster_tables("loose", "lo")


@query(
    "er_tfidf_ngrams",
    oracle("SELECT * FROM lo_weights", "name gram df", "weight", uses="loose", extra=_LOOSE[:5]),
)
def _(spark, sf):
    return clustering.tfidf(loose_names(spark, sf).where(F.length("name") > 1))


@query(
    "er_cosine_pairs",
    oracle("SELECT * FROM lo_cos", "name_a name_b", "cosine", uses="loose", extra=_LOOSE[:6]),
)
def _(spark, sf):
    return clustering.cosine_pairs(loose_names(spark, sf).where(F.length("name") > 1), EPS)


@query("er_cosine_pairs_approx")
def _(spark, sf):
    """The pairs that signatures find, with their exact cosine, beside the recall against all pairs."""
    names = loose_names(spark, sf).where(F.length("name") > 1)
    found = cut_lineage(clustering.approximate_pairs(names, EPS))
    recall = clustering.recall_of(found, clustering.cosine_pairs(names, EPS)).first()
    return found.select("*", F.lit(recall["n_exact"]).alias("n_exact"), F.lit(recall["recall"]).alias("recall"))


@query(
    "er_density_clusters",
    oracle("SELECT name, exemplar FROM lo_clusters", "name exemplar", uses="loose", extra=_LOOSE),
)
def _(spark, sf):
    return clustering.cluster_names(loose_names(spark, sf), EPS)


@query(
    "er_cluster_exemplar",
    oracle(
        "SELECT exemplar, count(*) AS n_members, min(name) AS first_member FROM lo_clusters GROUP BY 1",
        "exemplar n_members first_member", uses="loose", extra=_LOOSE,
    ),
)
def _(spark, sf):
    clusters = clustering.cluster_names(loose_names(spark, sf), EPS)
    return clusters.groupBy("exemplar").agg(F.count("*").alias("n_members"), F.min("name").alias("first_member"))


# --- the whole cascade ------------------------------------------------------------------
def resolved(spark, sf):
    return resolution.resolve_names(
        names_of(spark, sf), view(spark, sf, "dictionary"), view(spark, sf, "overrides"), THRESHOLD, EPS
    )


query(
    "er_resolve",
    oracle(
        "SELECT n.raw, n.normalised, coalesce(o.canonical, b.entry, c.exemplar, n.normalised) AS canonical, "
        "CASE WHEN o.canonical IS NOT NULL THEN 'manual' WHEN b.entry IS NOT NULL THEN 'fuzzy' "
        "WHEN c.exemplar IS NOT NULL THEN 'clustered' ELSE 'unknown' END AS method, "
        "CASE WHEN o.canonical IS NOT NULL THEN 100.0 ELSE b.score END AS score "
        "FROM normed n LEFT JOIN overrides o ON n.normalised = o.normalised "
        "LEFT JOIN accepted b ON n.normalised = b.normalised LEFT JOIN un_clusters c ON n.normalised = c.name",
        "raw normalised canonical method", "score", uses="forms overrides dictionary normed",
        extra=[
            *match_tables("open_forms"),
            ("accepted", f"SELECT * FROM fz_best WHERE score >= {THRESHOLD}"),
            (
                "unmatched",
                "SELECT normalised AS name, copies FROM open_forms WHERE normalised NOT IN (SELECT normalised FROM accepted)",
            ),
            *cluster_tables("unmatched", "un"),
        ],
    ),
)(resolved)


# A mapping without the similarity search: override, equal dictionary entry, or unknown.
cte(
    "quick_mapping",
    "normed overrides dictionary",
    "SELECT n.raw, n.normalised, coalesce(o.canonical, d.entry, n.normalised) AS canonical, "
    "CASE WHEN o.canonical IS NOT NULL THEN 'manual' WHEN d.entry IS NOT NULL THEN 'fuzzy' ELSE 'unknown' END AS method "
    "FROM normed n LEFT JOIN overrides o ON n.normalised = o.normalised LEFT JOIN dictionary d ON n.normalised = d.entry",
)


def quick_mapping(spark, sf):
    named = resolution.normalise_names(names_of(spark, sf)).select("raw", "normalised")
    manual = view(spark, sf, "overrides").withColumnRenamed("canonical", "_manual")
    known = view(spark, sf, "dictionary").select(F.col("entry").alias("normalised"), F.col("entry").alias("_entry"))
    method = F.when(F.col("_manual").isNotNull(), "manual").when(F.col("_entry").isNotNull(), "fuzzy").otherwise("unknown")
    return named.join(manual, "normalised", "left").join(known, "normalised", "left").select(
        "raw", "normalised", F.coalesce("_manual", "_entry", "normalised").alias("canonical"), method.alias("method")
    )


def simple_mapping(spark, sf, transactions=None):
    """raw -> normal form: the mapping of the feature queries; of the given ``transactions``, if any."""
    names = names_of(spark, sf) if transactions is None else resolution.name_counts(transactions)
    return resolution.normalise_names(names).select(
        "raw", "normalised", F.col("normalised").alias("canonical"), F.lit("rule").alias("method")
    )


@query(
    "er_apply_mapping",
    oracle(
        "SELECT company_id, transaction_date, amount, merchant_name, canonical FROM mapped",
        "company_id transaction_date merchant_name canonical", "amount", uses="mapped",
    ),
)
def _(spark, sf):
    return resolution.apply_mapping(view(spark, sf, "transactions"), simple_mapping(spark, sf)).select(
        "company_id", "transaction_date", "amount", "merchant_name", "canonical"
    )


@query(
    "er_lookup_name",
    oracle(
        f"SELECT w.raw, {duck_normalise('w.raw')} AS normalised, m.canonical, m.method, "
        "CASE WHEN m.raw IS NULL THEN 'not in data' ELSE 'found' END AS status FROM "
        "(SELECT DISTINCT p_name AS raw FROM part UNION ALL SELECT c_name FROM customer) w "
        "LEFT JOIN quick_mapping m ON w.raw = m.raw",
        "raw normalised canonical method status", uses="quick_mapping",
    ),
)
def _(spark, sf):
    wanted = view(spark, sf, "part").select(F.col("p_name").alias("raw")).distinct().union(
        view(spark, sf, "customer").select("c_name")
    )
    return resolution.lookup_names(wanted, quick_mapping(spark, sf))


@query(
    "er_method_counts",
    oracle(
        "SELECT method, count(*) AS n, (SELECT count(DISTINCT raw) FROM quick_mapping) AS distinct_raw, "
        "(SELECT count(DISTINCT canonical) FROM quick_mapping) AS distinct_canonical FROM quick_mapping GROUP BY 1",
        "method n distinct_raw distinct_canonical", uses="quick_mapping",
    ),
)
def _(spark, sf):
    return resolution.method_summary(quick_mapping(spark, sf))


# --- evaluation -------------------------------------------------------------------------
cte(
    "truth",
    "names taxonomy",
    f"SELECT n.raw AS raw_name, {duck_normalise('coalesce(t.first_variant, n.raw)')} AS true_canonical FROM names n "
    "LEFT JOIN (SELECT variant, arg_min(first_variant, group_rank) AS first_variant FROM taxonomy GROUP BY 1) t "
    "ON n.raw = t.variant",
)
cte("judged", "quick_mapping truth", "SELECT m.*, t.true_canonical FROM quick_mapping m JOIN truth t ON m.raw = t.raw_name")


def truth_of(spark, sf):
    return resolution_eval.truth_from_taxonomy(names_of(spark, sf), view(spark, sf, "taxonomy"))


def judged(spark, sf):
    return resolution_eval.join_truth(quick_mapping(spark, sf), truth_of(spark, sf))


_HIT = "CAST(canonical = true_canonical AS INT)"
query(
    "ev_join_truth",
    oracle("SELECT * FROM judged", "raw normalised canonical method true_canonical", uses="judged"),
)(lambda spark, sf: judged(spark, sf).select("raw", "normalised", "canonical", "method", "true_canonical"))
query(
    "ev_accuracy",
    oracle(f"SELECT avg({_HIT}) AS overall_accuracy, count(*) AS n_evaluated FROM judged", "n_evaluated", "overall_accuracy", uses="judged"),
)(lambda spark, sf: resolution_eval.accuracy(judged(spark, sf)))
query(
    "ev_method_accuracy",
    oracle(f"SELECT method, avg({_HIT}) AS accuracy, count(*) AS n FROM judged GROUP BY 1", "method n", "accuracy", uses="judged"),
)(lambda spark, sf: resolution_eval.method_accuracy(judged(spark, sf)))
query(
    "ev_coverage",
    oracle("SELECT avg(CAST(canonical <> normalised AS INT)) AS coverage FROM judged", "", "coverage", uses="judged"),
)(lambda spark, sf: resolution_eval.coverage(judged(spark, sf)))
query(
    "ev_confusion",
    oracle(
        "SELECT raw, normalised, canonical, true_canonical, method FROM judged WHERE canonical <> true_canonical ORDER BY raw LIMIT 20",
        "raw normalised canonical true_canonical method", uses="judged",
    ),
)(lambda spark, sf: resolution_eval.confusion_sample(judged(spark, sf)))
query(
    "ev_truth_taxonomy", oracle("SELECT * FROM truth", "raw_name true_canonical", uses="truth")
)(truth_of)


@query(
    "ev_volume_coverage",
    oracle(
        "SELECT sum(CASE WHEN m.canonical IS NULL OR m.canonical <> m.raw THEN abs(t.amount) ELSE 0 END) * 1.0 / sum(abs(t.amount)) AS volume_coverage, "
        "sum(CASE WHEN m.canonical <> m.raw THEN abs(t.amount) ELSE 0 END) * 1.0 / sum(abs(t.amount)) AS strict_coverage "
        "FROM (SELECT merchant_name, CAST(amount AS DOUBLE) AS amount FROM transactions) t "
        "LEFT JOIN (SELECT * FROM quick_mapping WHERE length(raw) % 4 <> 0) m ON t.merchant_name = m.raw",
        "", "volume_coverage strict_coverage", uses="transactions quick_mapping",
    ),
)
def _(spark, sf):
    partial = quick_mapping(spark, sf).where("length(raw) % 4 <> 0")
    return resolution_eval.volume_coverage(view(spark, sf, "transactions"), partial)


@query(
    "ev_evaluate",
    oracle(
        f"SELECT method, avg({_HIT}) AS accuracy, count(*) AS n, (SELECT avg({_HIT}) FROM judged) AS overall_accuracy, (SELECT count(*) FROM judged) AS n_evaluated, "
        "(SELECT avg(CAST(canonical <> normalised AS INT)) FROM judged) AS coverage, "
        "(SELECT sum(CASE WHEN m.canonical IS NULL OR m.canonical <> m.raw THEN abs(CAST(t.amount AS DOUBLE)) ELSE 0 END) / sum(abs(CAST(t.amount AS DOUBLE))) "
        "FROM transactions t LEFT JOIN quick_mapping m ON t.merchant_name = m.raw) AS volume_coverage FROM judged GROUP BY 1",
        "method n n_evaluated", "accuracy overall_accuracy coverage volume_coverage", uses="judged transactions quick_mapping",
    ),
)
def _(spark, sf):
    """The combined evaluation, one row for each method."""
    mapping = quick_mapping(spark, sf)
    row = resolution_eval.evaluate(mapping, truth_of(spark, sf), view(spark, sf, "transactions"))
    return row.select(F.inline("method_accuracy"), "overall_accuracy", "n_evaluated", "coverage", "volume_coverage")


@query(
    "ev_truth_sample",
    oracle(
        f"SELECT raw AS raw_name, {duck_normalise('raw')} AS true_canonical FROM names ORDER BY md5(concat(raw, '|42')), raw LIMIT 500",
        "raw_name true_canonical", uses="names",
    ),
)
def _(spark, sf):
    return resolution_eval.truth_sample(names_of(spark, sf), 500, 42)


cte("later_mapping", "quick_mapping", "SELECT * FROM quick_mapping WHERE length(raw) % 6 <> 0")
_BAG = "SELECT normalised, canonical FROM {0}"


@query(
    "ev_mapping_drift",
    oracle(
        " UNION ALL ".join(
            f"SELECT normalised, canonical, '{name}' AS change, count(*) AS n FROM ({a} {op} ALL {b}) x GROUP BY 1, 2"
            for name, a, op, b in (
                ("kept", "SELECT normalised, normalised AS canonical FROM normed", "INTERSECT", _BAG.format("later_mapping")),
                ("removed", "SELECT normalised, normalised AS canonical FROM normed", "EXCEPT", _BAG.format("later_mapping")),
                ("added", _BAG.format("later_mapping"), "EXCEPT", "SELECT normalised, normalised AS canonical FROM normed"),
            )
        ),
        "normalised canonical change n", uses="normed later_mapping",
    ),
)
def _(spark, sf):
    """From the mapping by rules to a later one, which knows overrides and lacks some names."""
    later = cut_lineage(quick_mapping(spark, sf).where("length(raw) % 6 <> 0"))
    return resolution_eval.mapping_drift(cut_lineage(simple_mapping(spark, sf)), later)
