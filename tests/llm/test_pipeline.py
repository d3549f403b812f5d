import corpus_pipeline
from gridweave.llm import toxicity

SF = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    sizes, kept = [docs.count()], docs
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, kept, SF)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
            # only whole rows of the stage before
            before = {tuple(r) for r in kept.collect()}
            assert all(tuple(r) in before for r in after.collect())
        sizes.append(after.count())
        if n < 4:
            kept = after.cache()
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[2] < sizes[1]
    assert sizes[4] == sizes[5]
    marked = kept.join(labels, "doc_id")
    assert marked.filter("toxic = 1").count() <= 1
    clean = docs.join(labels, "doc_id").filter("toxic = 0 and quality = 1").count()
    assert marked.filter("toxic = 0 and quality = 1").count() > 0.6 * clean


def test_run_gives_tokens(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_tokens", "token_ids", "round_trip"]
    assert got.filter("not round_trip").count() == 0 and got.count() > 0


def test_toxicity_of_the_stage_is_that_of_the_operator(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    w, b = toxicity.train(docs, labels)
    scores = docs.select("doc_id", "text").mapInArrow(toxicity.scorer(w, b, "doc_id"), "doc_id long, score double")
    want = {r.doc_id for r in scores.filter("score < 0.3").collect()}
    assert {r.doc_id for r in toxicity.keep_clean(docs, labels).collect()} == want
