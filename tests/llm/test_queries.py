import pytest

import __spark_entry__ as driver
from obslake.llm.queries import ORACLES
from tests.llm.oracle import by_spark, by_sql


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    expected = by_sql(name, sf_dir)
    assert expected and by_spark(spark, name, sf_dir) == expected


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in driver.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in driver.queries()
