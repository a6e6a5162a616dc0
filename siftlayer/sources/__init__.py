"""Scans: delimited text with a fixed schema, and catalog tables."""

from siftlayer.sources.delimited import TextSource, locate
from siftlayer.sources.tables import read_snapshot, read_table

__all__ = ["TextSource", "locate", "read_snapshot", "read_table"]
