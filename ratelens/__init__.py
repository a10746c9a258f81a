"""ratelens: rate-shopping data work on Spark.

Requests (a manifest of stays) plus already captured result pages go in;
offers, requests to try again, and a coverage summary come out.  All the
heavy work is expressed as DataFrame operations so that Catalyst and AQE
plan it; the only Python on the hot path is one Arrow-batched HTML
extractor for markup that regular expressions cannot read.
"""

from ratelens.operators.extract import NativeLayout, ParsedLayout, Test
from ratelens.plans.layouts import DEFAULT_LAYOUTS, dump_layouts, load_layouts
from ratelens.plans.rateshop import RunOutputs, run_rate_shop
from ratelens.session import checkpoint_dir, get_session
from ratelens.sources.captures import read_captures
from ratelens.sources.manifest import read_manifest, reattempt_manifest
from ratelens.sources.sinks import write_outputs

__all__ = [
    "DEFAULT_LAYOUTS", "NativeLayout", "ParsedLayout", "RunOutputs", "Test",
    "checkpoint_dir", "dump_layouts", "get_session", "load_layouts", "read_captures",
    "read_manifest", "reattempt_manifest", "run_rate_shop", "write_outputs",
]
