import pytest

from millrace.plans import catalogue

from .helpers import assert_same

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.ORACLES:
        assert_same(df, catalogue.ORACLES[name], SF)
    else:
        assert df.count() > 0
