"""All registered queries and their SQL counterparts."""

from vanecast.catalog import (  # noqa: F401
    aggregates,
    cleaning,
    drifting,
    features,
    forecasting,
    joining,
    modelling,
    sampled,
    storage,
    streamed,
)
from vanecast.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
