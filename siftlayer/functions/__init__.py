"""Column expressions: text to values, calendar parts, guarded ratios."""

from siftlayer.functions.calendar import day_part, elapsed_minutes, is_weekend
from siftlayer.functions.casting import parse_text
from siftlayer.functions.ratios import guarded_percentage, guarded_quotient

__all__ = [
    "day_part",
    "elapsed_minutes",
    "guarded_percentage",
    "guarded_quotient",
    "is_weekend",
    "parse_text",
]
