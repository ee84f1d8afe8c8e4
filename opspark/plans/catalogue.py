"""All registered queries."""

from opspark.plans import (  # noqa: F401
    audit_queries, evaluation_queries, feature_queries, flow_queries, learner_queries, readback_queries, service_queries, table_queries,
)
from opspark.plans.registry import COVERS, ORACLES, QUERIES  # noqa: F401
