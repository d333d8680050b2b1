"""docflow: document ingest and routing over Spark DataFrames and Structured Streaming."""

from docflow.session import build_session, configure, workspace

__all__ = ["build_session", "configure", "workspace"]
