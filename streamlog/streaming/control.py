"""Ending a streaming query without losing what was read."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def drain(query: StreamingQuery) -> None:
    """Work off all input that is there, commit it, and stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a query with an ``availableNow`` trigger; raises what it raised."""
    query.awaitTermination()
