"""All queries of the engine; importing the query modules fills the registry."""

from tracklore.plans import report_queries, join_queries, filter_queries, episode_queries, weather_queries, space_queries, contract_queries, stream_queries
from tracklore.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "filter_queries", "join_queries", "report_queries"]
