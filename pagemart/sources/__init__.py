"""Readers: test-table adapters, page lists, landed API responses, layer tables."""

from . import testdata

__all__ = ["testdata"]
