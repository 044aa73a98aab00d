"""All registered queries."""

from rowharbor.plans import (  # noqa: F401
    catalogue_queries,
    geo_queries,
    job_queries,
    publish_queries,
    scan_queries,
)
from rowharbor.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
