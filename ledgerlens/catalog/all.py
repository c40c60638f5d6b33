"""Importing this module fills the registry."""

from ledgerlens.catalog import job_queries, quality_queries, streaming_queries, telemetry_queries, text_queries  # noqa: F401
from ledgerlens.catalog.registry import REGISTRY  # noqa: F401
