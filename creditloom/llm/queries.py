"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from creditloom.llm import (
    centroid_clusters,
    decontamination,
    histogram_shards,
    html_extract,
    language_id,
    license_scan,
    ngram_join,
    pii,
    quality_rules,
    secret_scan,
    source_mixing,
    token_counts,
    vector_codes,
)
from creditloom.llm.text import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


@query("op5_ngram_jaccard")
def op5(spark, sf_dir):
    found = ngram_join.ngram_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


@query("op7_language_id")
def op7(spark, sf_dir):
    return language_id.learn_and_identify(table(spark, sf_dir, "documents"))


@query("op3_decontamination")
def op3(spark, sf_dir):
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_secret_scan")
def op4(spark, sf_dir):
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@query("op6_source_mixing", source_mixing.oracle())
def op6(spark, sf_dir):
    return source_mixing.digest(table(spark, sf_dir, "documents"))


@query("op2_quality_rules")
def op2(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_pii")
def op8(spark, sf_dir):
    return pii.digest(table(spark, sf_dir, "documents"))


@query("op10_license_scan")
def op10(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


@query("op1_token_counts")
def op1(spark, sf_dir):
    return token_counts.count_cleaned(table(spark, sf_dir, "documents"))


@query("op9_html_extract")
def op9(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query("op11_vector_codes", vector_codes.oracle())
def op11(spark, sf_dir):
    return vector_codes.digest(table(spark, sf_dir, "embeddings"))


@query("op12_centroid_clusters", centroid_clusters.oracle())
def op12(spark, sf_dir):
    return centroid_clusters.cluster(table(spark, sf_dir, "embeddings"))


@query("op13_histogram_shards", histogram_shards.oracle())
def op13(spark, sf_dir):
    return histogram_shards.shard(table(spark, sf_dir, "documents"))
