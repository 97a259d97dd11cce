import corpus_pipeline


def test_stages_keep_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.Scratch(spark, "test").table(stage(spark, docs, sf))
        assert docs.columns == columns, name
    assert before > docs.count() > before // 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == docs.count() == last.filter("same").count()
    assert corpus_pipeline.run(spark, sf).count() == docs.count()
