"""Wind-farm telemetry analytics on Spark DataFrames."""

from .session import build_session, materialize

__all__ = ["build_session", "materialize"]
