"""The pipeline's language stage where no row has a label."""

import corpus_pipeline


def test_unlabelled_texts_stay(spark):
    rows = [(1, "some words", None, "s", 10), (2, "12 !?", None, "s", 5), (3, None, None, "s", 0), (4, "", None, "s", 0), (5, "é", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5]
