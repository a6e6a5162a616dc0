"""Give text columns their types and final names in one projection."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlayer.functions.casting import parse_text


@dataclass(frozen=True)
class Field:
    """One output column: its name, its type and the text column it is read from."""

    name: str
    type: str
    source: str | None = None

    @property
    def origin(self) -> str:
        return self.source or self.name


def apply_types(df: DataFrame, fields: Iterable[Field], on_error: str = "null") -> DataFrame:
    """Type the columns named by ``fields``; keep all others as they are.

    A field that keeps its name is replaced in place.  A renamed field drops its
    source column and goes to the end, in the order of ``fields``.
    """
    fields = list(fields)
    parsed = {
        f.name: parse_text(F.col(f.origin), f.type, on_error, label=f.origin).alias(f.name)
        for f in fields
    }
    renamed = [f for f in fields if f.origin != f.name]
    dropped = {f.origin for f in renamed}
    moved = {f.name for f in renamed}
    in_place = [
        parsed.get(c, F.col(c)) for c in df.columns if c not in dropped and c not in moved
    ]
    return df.select(*in_place, *(parsed[f.name] for f in renamed))
