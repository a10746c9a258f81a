"""Incremental runs: captured pages processed as they arrive."""

from ratelens.streaming.captures import CAPTURE_SCHEMA, latest_outcomes, stream_rate_shop

__all__ = ["CAPTURE_SCHEMA", "latest_outcomes", "stream_rate_shop"]
