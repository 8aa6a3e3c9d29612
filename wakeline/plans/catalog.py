"""All registered queries. Importing the query modules fills the registry."""

from __future__ import annotations

from wakeline.plans import geo_queries, message_queries, track_queries, vessel_queries
from wakeline.plans.registry import QUERIES, SQL

MODULES = (message_queries, vessel_queries, track_queries, geo_queries)
flagship = geo_queries.flagship

__all__ = ["MODULES", "QUERIES", "SQL", "flagship"]
