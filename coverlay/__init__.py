"""Polygon coverages as Spark DataFrames: spatial joins, dissolve, overlay, gap repair, thinning and QA."""

from coverlay.kernel import KernelUnavailable, enable

__all__ = ["KernelUnavailable", "enable"]
