"""Scores of the language model do not depend on how documents are dealt out."""

from loadlens.llm.language_model import score_texts
from loadlens.llm.shared import RELEASE, stored


def test_same_scores_in_any_partitions(spark, documents):
    one, many = ({r.doc_id: (r.score, r.base_score) for r in score_texts(documents.repartition(n, "doc_id")).collect()} for n in (1, 7))
    assert one.keys() == many.keys()
    assert all(abs(a - b) <= 1e-9 * abs(a) for d in one for a, b in zip(one[d], many[d]))


def test_released_shuffles_leave_the_setting_and_the_rows(spark):
    before = spark.conf.get(RELEASE, None)
    df = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
    table = stored(df, "released", release=True)
    assert spark.conf.get(RELEASE, None) == before
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, df.collect())) == [(i, 100) for i in range(10)]
