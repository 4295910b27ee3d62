"""File-source streaming ingest of newly landed bronze files."""

from monthly_facts.streaming.ingest_stream import (
    ingest_stream,
    months_in,
    refresh_months,
    run_stream_once,
)

__all__ = ["ingest_stream", "months_in", "refresh_months", "run_stream_once"]
