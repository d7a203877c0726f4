"""Imports every query module so the registry is complete."""

from __future__ import annotations

from . import dirty_queries, governance_queries, ledger_queries, incremental_queries, mart_queries, quality_queries, recovery_queries, source_queries, stream_queries, threshold_queries, timer_queries  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
