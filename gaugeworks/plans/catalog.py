"""All registered queries and their checking SQL."""
from gaugeworks.plans import (analysis_queries, cleaning_queries, cluster_queries,  # noqa: F401
                              source_queries, state_queries)
from gaugeworks.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
