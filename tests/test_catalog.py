"""Every registered query against its SQL, on the smallest tables."""

import pytest

from catalog import ORACLES, QUERIES
from tests.compare import difference
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    if name in ORACLES:
        assert difference(spark, con, name, SMALL) is None
    else:
        assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_is_stable(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    first = __spark_entry__.entry(spark)
    assert first.count() > 0
    assert first.schema == __spark_entry__.entry(spark).schema
