import pytest

from millrace.operators import quality
from millrace.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["quality_score", "quality_filter"])
def test_text_and_words_are_computed_once(spark, name):
    plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 3 and plan.count("split(") == 1


def test_odd_texts(spark):
    texts = [(0, None), (1, ""), (2, "   "), (3, "ab\ncd ab"), (4, "x  Ωmega")]
    rows = quality.HeuristicModel().score(spark.createDataFrame(texts, "i long, t string"), "t", "s").orderBy("i").collect()
    want = [None, 0.0, 0.0, (6 / 8 + 1 + 2 / 3 + 3 / 50) / 4, (5 / 8 + 1 / 2 + 1 + 2 / 50) / 4]
    assert [r.s for r in rows] == [w if w is None else pytest.approx(w) for w in want] and [(r.i, r.t) for r in rows] == texts
