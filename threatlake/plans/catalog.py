"""All registered queries."""

from __future__ import annotations

from . import auditing, evidence, linked, searching, streams, truth  # noqa: F401  (registering)
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
