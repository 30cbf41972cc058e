import pytest

from heronlake.operators import lateness
from heronlake.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(catalog.QUERIES[name], catalog.SQL[name])


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


def test_approximate_quantiles_are_near(spark, sf_dir):
    rows = catalog.QUERIES["lateness_model"](spark, sf_dir)
    a, b = lateness.quantiles(rows).first(), lateness.quantiles(rows, approximate=False).first()
    assert all(abs(x - y) <= max(1.0, 0.1 * y) for x, y in zip(a, b))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
