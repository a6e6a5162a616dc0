"""Sinks: partitioned append with schema growth, and whole-table replacement."""

from siftlayer.sinks.tables import (
    append_partitioned,
    recluster_partitions,
    recluster_table,
    replace_table,
)

__all__ = ["append_partitioned", "recluster_partitions", "recluster_table", "replace_table"]
