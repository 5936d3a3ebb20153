"""All registered queries (importing the query modules fills the registry)."""

from __future__ import annotations

from barflow.plans import q_explore, q_features, q_io, q_ml, q_model, q_stream, q_tsa  # noqa: F401
from barflow.plans.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
