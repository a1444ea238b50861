"""Imports every query module, so that the registry is full."""

from __future__ import annotations

from . import check_queries, graph_queries, log_queries, network_queries, place_queries, sink_queries, source_queries, table_queries
from .registry import ORACLES, QUERIES

MODULES = (check_queries, graph_queries, log_queries, network_queries, place_queries, sink_queries, source_queries, table_queries)
__all__ = ["MODULES", "ORACLES", "QUERIES"]
