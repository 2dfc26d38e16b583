"""Every registered query with a SQL twin gives the same rows on the smallest tables."""

import pytest

from compare import connect, differences
from fathomline.plans import registry

# One unit of the eighth decimal: averages of a few rows on the smallest tables can be exact halves.
ROUNDING = 1.01e-8


@pytest.fixture(scope="module")
def connection(small_tables):
    return connect(small_tables)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_rows(spark, connection, small_tables, name):
    assert differences(spark, connection, small_tables, registry.QUERIES[name], registry.ORACLE[name],
                       ROUNDING) == []


def test_every_twin_has_a_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES)
