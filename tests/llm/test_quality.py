"""How many rows are drawn, whatever their ids."""

import pytest

from starloom.llm.quality import resample


@pytest.mark.parametrize("text", ["the cat {} sat on the mat", "the same text"])
def test_rows_without_id_do_not_share_a_draw(spark, text):
    rows = [(k if k < 500 else None, text.format(k % 5), 0.5, 1) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_ratio double, _c0 int")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(500)], "doc_id long, quality int, toxic int")
    drawn = resample(spark, docs, labels, share=0.5)
    assert drawn.columns == [*docs.columns, "_log_ratio"]
    ids = [r.doc_id for r in drawn.collect()]
    assert len(ids) == 500 and 150 < ids.count(None) < 350


def test_one_id_with_many_texts(spark):
    docs = spark.createDataFrame([(7, f"text {k}") for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int")
    assert resample(spark, docs, labels, share=0.25).count() == 100
