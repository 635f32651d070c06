"""All registered queries by name."""

from downfold.plans import metric_queries, outage_queries, table_queries
from downfold.plans.tables import Query

QUERIES: dict[str, Query] = {**outage_queries.QUERIES, **metric_queries.QUERIES, **table_queries.QUERIES}
