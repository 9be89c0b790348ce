"""Spatial partitioning of large sky catalogues on Spark DataFrames."""

from . import functions, operators, plans, sinks, sources, streaming
from .session import checkpoint_root, local_session, scratch_path

__all__ = ["functions", "operators", "plans", "sinks", "sources", "streaming",
           "checkpoint_root", "local_session", "scratch_path"]
