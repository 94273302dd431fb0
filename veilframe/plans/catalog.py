"""All checkable queries of the library, by name."""

from __future__ import annotations

from ..functions.registry import ORACLES, QUERIES
from . import geometry_queries, keypoint_queries, mask_queries, matching_queries, metric_queries, pixel_queries, selection_queries  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
