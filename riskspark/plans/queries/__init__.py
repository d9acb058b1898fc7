"""Registered queries over the driver's tables, each with its SQL where SQL can say it."""

from riskspark.plans.queries import (  # noqa: F401
    cleaning,
    drifting,
    evaluating,
    featuring,
    modelling,
    profiling,
    sourcing,
    streams,
    telemetry,
    validating,
)
from riskspark.plans.queries.base import QUERIES, SQL  # noqa: F401
