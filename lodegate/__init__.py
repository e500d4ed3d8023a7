"""Provenance-first document processing on Spark DataFrames."""

from lodegate.session import build_session, tune

__all__ = ["build_session", "tune"]
