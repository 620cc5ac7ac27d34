"""All registered plans, by section of the operator inventory."""

from tidemark.plans import (  # noqa: F401
    aggregate_plans,
    entity_plans,
    explore_plans,
    expression_plans,
    join_plans,
    label_plans,
    model_plans,
    projection_plans,
    source_plans,
    window_plans,
    workload_plans,
)
from tidemark.plans.registry import PLANS  # noqa: F401
