"""Query bindings over the supplied tables."""

from tallyfield.plans import cohort_plans, customer_plans, feature_plans, history_plans, learning_plans, mart_plans, model_plans, quality_plans, source_plans, stream_plans, traffic_plans  # noqa: F401
from tallyfield.plans.registry import ORACLES, QUERIES  # noqa: F401
