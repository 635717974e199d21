"""Named queries over the given tables, each with SQL that states its result."""

from __future__ import annotations

from rivermark.registry import grouped, joined, messages, ordered, quality, scalars, scans, sinks, streams
from rivermark.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "grouped", "joined", "messages", "ordered", "quality", "scalars",
           "scans", "sinks", "streams"]
