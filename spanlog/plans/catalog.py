"""Imports every query module so that the registry is complete."""

from . import chain_queries, commit_queries, history_queries, mode_queries, source_queries, stream_queries, timecell_queries, travel_queries, upkeep_queries  # noqa: F401
from .registry import HEADLINE, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "HEADLINE"]
