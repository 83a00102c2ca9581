"""Snapshot, tag and message analytics written as PySpark jobs."""

from tidemark.session import get_session

__all__ = ["get_session"]
