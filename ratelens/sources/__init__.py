"""Sources and sinks: the manifest CSV, captured pages, driver tables, outputs."""

from ratelens.sources.captures import conform_captures, read_captures
from ratelens.sources.manifest import read_manifest, sample_manifest
from ratelens.sources.tables import read_table

__all__ = ["conform_captures", "read_captures", "read_manifest", "read_table",
           "sample_manifest"]
