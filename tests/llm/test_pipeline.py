import hashlib

import corpus_pipeline
from creditloom.llm import decontamination, language_id, secret_scan, source_mixing
from creditloom.llm.text import table
from tests.llm.brute import components, odd_rows

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs = table(spark, SF, "documents").toPandas()
    model = language_id.train(table(spark, SF, "documents").where(~language_id.held_out()))
    docs = docs[[x[1] >= 0.25 for x in model.describe(docs["text"].tolist())]]
    groups = components(list(zip(docs["doc_id"], docs["text"], strict=True)))
    docs = docs[[groups[d][1] == d for d in docs["doc_id"]]]
    items = [decontamination.normal(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    finder = decontamination.Finder(list(enumerate(items)), decontamination.ERROR_RATE)
    docs = docs[[not list(finder.hits(decontamination.normal(t))) for t in docs["text"]]]
    clean = secret_scan.masked(spark.createDataFrame(docs)).toPandas()
    weights = {r["doc_id"]: r["probability"] for r in source_mixing.mix(spark.createDataFrame(clean)).collect()}
    want = {d: p for d, p in weights.items() if int(hashlib.md5(str(d).encode()).hexdigest()[:12], 16) / 16**12 < p}
    got = {r["doc_id"]: r["probability"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-9 for d in got)
    assert 0 < len(got) < len(clean)


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = odd_rows(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns[0] == "doc_id"
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
