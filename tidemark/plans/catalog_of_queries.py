"""Imports every query module, so that the registry is complete."""

from tidemark.plans import (  # noqa: F401
    q_aggregates,
    q_business,
    q_cleansing,
    q_functions,
    q_joins,
    q_model,
    q_quality,
    q_sources,
    q_windows,
)
from tidemark.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
