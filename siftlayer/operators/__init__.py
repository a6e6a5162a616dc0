"""Lazy DataFrame operators: lineage, typing, validity, dedup, metrics, layout."""

from siftlayer.operators.dedup import deduplicate
from siftlayer.operators.layout import order_by_morton_key, order_by_range
from siftlayer.operators.lineage import add_lineage, add_month_partitions
from siftlayer.operators.metrics import mean, ratio_of_totals, row_count, summarise, total
from siftlayer.operators.typed import Field, apply_types
from siftlayer.operators.validity import keep_valid

__all__ = [
    "Field",
    "add_lineage",
    "add_month_partitions",
    "apply_types",
    "deduplicate",
    "keep_valid",
    "mean",
    "order_by_morton_key",
    "order_by_range",
    "ratio_of_totals",
    "row_count",
    "summarise",
    "total",
]
