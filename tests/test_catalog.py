"""Every core query against its SQL over the smallest tables."""

from pathlib import Path

import pytest
from oracle import FOLDER, connect, same

from headwaykit.plans import catalog

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    same(spark, con, catalog.queries()[name], catalog.oracle_sql()[name])


def test_entry_has_rows_and_every_statement_its_query(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
