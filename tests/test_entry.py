import os

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(entry.queries()) - set(entry.oracle_sql())
    text = {n for n in without if n == "pipeline" or (n.startswith("op") and "_" in n)}
    # All pairs of line items are too many for SQL; tests/test_neighbours.py has the brute force.
    assert without - text == {"mi_neighbours_lines"}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are absent")
def test_flagship(spark):
    features = entry.entry(spark)
    assert len(features.columns) == 3 + 33
    assert features.count() > 0
