"""The corpus pipeline: each stage against a direct version on its own input, and odd rows through all of them."""

import corpus_pipeline
from shared_tables import SF, odd, table  # noqa: F401
from test_operators import base_spans, contamination, jaccard_components


def test_stages_on_their_own_input(spark, table):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard", "decontaminate", "secrets", "packing"]
    clean = stages["toxicity"](spark, docs, SF)
    toxic = {r["doc_id"] for r in table("labels") if r["toxic"] == 1}
    kept = [r.asDict() for r in clean.collect()]
    gone = {r.doc_id for r in docs.collect()} - {r["doc_id"] for r in kept}
    labelled = {r["doc_id"] for r in table("labels")}
    assert clean.columns == columns and len(gone & labelled - toxic) <= 2 and len(gone & toxic) >= 0.7 * len(toxic)

    one = stages["ngram_jaccard"](spark, docs, SF)
    groups = jaccard_components([(r["doc_id"], r["text"]) for r in table("documents")])
    assert one.columns == columns and sorted(r.doc_id for r in one.collect()) == sorted({c for _, c in groups.values()})

    free = stages["decontaminate"](spark, docs, SF)
    found = contamination([(r["doc_id"], r["text"]) for r in table("documents")], [(r["item_id"], r["text"]) for r in table("benchmark")])
    assert free.columns == columns and sorted(r.doc_id for r in free.collect()) == sorted(d for d, x in found.items() if not x[4])

    safe = stages["secrets"](spark, docs, SF)
    assert safe.columns == columns and safe.count() == docs.count()
    assert all(not base_spans(r.text) and r.n_chars == len(r.text) for r in safe.collect())


def test_run_keeps_every_token_of_what_stays(spark):
    out = corpus_pipeline.run(spark, SF)
    per = out.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).toDF("doc_id", "n", "total").collect()
    assert per and all(r.n == r.total for r in per)


def test_odd_rows_pass_through(spark, odd):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns, name
        assert {r.doc_id for r in out.collect()} >= {1, 2, 3, 4, 5, None} - ({6} if name == "ngram_jaccard" else set()), name
        assert stage(spark, odd.where("false"), SF).count() == 0, name
