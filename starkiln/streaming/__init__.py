"""Structured Streaming jobs: exactly-once landing-folder ingest and auto-refreshed tables."""

from .file_ingest import stream_ingest  # noqa: F401
from .refresh import refresh, refresh_stream  # noqa: F401
from .maintained import Measure, maintain_aggregate  # noqa: F401
from .refresh import alter_refreshed, create_refreshed, refresh_if_due  # noqa: F401
