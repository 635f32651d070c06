import pytest

import oracle
from downfold.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    query = QUERIES[name]
    assert query.sql is not None
    assert oracle.differences(query.run(spark, SF_DIR), con, query.sql) == ""


def test_known_counts(spark):
    """Figures worked out independently when the inputs were first surveyed (sf0.01)."""
    sf_dir = "/root/testdata/sf0.01"
    assert QUERIES["total_outages"].run(spark, sf_dir).first()[0] == 2358
    assert QUERIES["downtime_intervals_late"].run(spark, sf_dir).count() == 2062
    assert QUERIES["downtime_intervals_by_event_time"].run(spark, sf_dir).count() == 2367
    assert QUERIES["active_down_nodes"].run(spark, sf_dir).first()[0] == 61
    assert QUERIES["outage_count_recent"].run(spark, sf_dir).first()[0] == 235
    assert QUERIES["max_duration_recent"].run(spark, sf_dir).first()[0] == 164.954
    assert QUERIES["max_outages_per_node"].run(spark, sf_dir).first()[0] == 27
    assert QUERIES["node_sla_report"].run(spark, sf_dir).count() == 2073
    entry = QUERIES["node_sla_report"].run(spark, SF_DIR)
    assert entry.count() == 206
