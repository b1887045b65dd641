"""Spark operators for building, appending to, profiling and checking star schemas."""

from starloom.session import build_session, scratch_path
from starloom.values import UNKNOWN_NUMBER, UNKNOWN_TEXT

__all__ = ["UNKNOWN_NUMBER", "UNKNOWN_TEXT", "build_session", "scratch_path"]
