"""All registered queries, by importing the modules that register them."""

from pressmill.plans import (  # noqa: F401
    columns,
    curate,
    dedupe_queries,
    listing_queries,
    period_queries,
    run_queries,
    ranking_queries,
    rule_queries,
    source_queries,
)
from pressmill.plans.registry import ORACLES, QUERIES  # noqa: F401
