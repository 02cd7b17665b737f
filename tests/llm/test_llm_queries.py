import pytest

import __spark_entry__ as entry
from lakemart.llm.queries import ORACLES, QUERIES
from oracle_check import compare, connect


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, name):
    path = f"/root/testdata/{folder}"
    verdict, *_ = compare(spark, connect(path), path, name, QUERIES[name], ORACLES[name])
    assert verdict == "ok", verdict


def test_every_query_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
