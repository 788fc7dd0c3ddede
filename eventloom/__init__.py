"""Event and commerce analytics as plain Spark DataFrame functions."""

from eventloom.session import get_session, tune

__all__ = ["get_session", "tune"]
