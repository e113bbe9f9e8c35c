"""All registered queries; importing this module fills the registry."""

from tidecall.plans import (  # noqa: F401
    queries_cleaning,
    queries_evaluate,
    queries_model,
    queries_profile,
    queries_runs,
    queries_split,
    queries_tables,
)
from tidecall.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
