"""The query catalogue: name -> DataFrame builder, and the same in SQL where SQL can say it."""

from __future__ import annotations

from voxloom.plans import labelling_queries, loss_queries, manifest_queries, segment_queries, signal_queries, text_queries, vector_queries  # noqa: F401
from voxloom.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
