"""Delimited files read as text under a schema fixed in advance."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlayer.sources.tables import plain_path
from siftlayer.tuning import settings

# Lines that a task fetches at a time while it looks for a header.
_FEW_LINES = 16


@dataclass(frozen=True)
class TextSource:
    """Delimited files with a header line: a name to speak of them by, and where they lie.

    Columns are taken by position.  With ``check_header`` a file whose header names
    differ from the schema stops the scan; with ``by_name`` they are taken by the
    names that each file's header gives them.
    """

    name: str
    path: str
    check_header: bool = False
    by_name: bool = False

    def scan(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All files, without any inference pass.

        Short lines are padded with nulls, surplus fields are dropped, blanks are
        null.  By name, upper and lower case are the same, columns that a file
        lacks are null, and those that the schema lacks are dropped.
        """
        if not self.by_name:
            return self._read(spark, schema, [self.path], not self.check_header)
        # One scan for each distinct header; files of one feed have few of them.
        groups = headers(spark, self.path)
        if not groups:
            return spark.createDataFrame([], schema)
        parts = [self._named(spark, schema, line, files) for line, files in sorted(groups.items())]
        return reduce(DataFrame.unionByName, parts)

    def _read(self, spark: SparkSession, schema: T.StructType, paths: list[str], enforce: bool) -> DataFrame:
        reader = spark.read.schema(schema).options(header=True, mode="PERMISSIVE", enforceSchema=enforce)
        return reader.csv(paths)

    def _named(self, spark: SparkSession, schema: T.StructType, line: str, files: list[str]) -> DataFrame:
        wanted = {f.name.lower(): f for f in schema.fields}
        fields, held = [], set()
        for place, title in enumerate(next(csv.reader([line]))):
            field = wanted.get(title.strip().lower())
            if field is None or field.name in held:
                fields.append(T.StructField(f"_surplus_{place}", T.StringType()))
            else:
                fields.append(field)
                held.add(field.name)
        rows = self._read(spark, T.StructType(fields), files, True)
        return rows.select(
            *(F.col(f.name) if f.name in held else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields)
        )

    def present(self, spark: SparkSession) -> bool:
        """Whether there is a file to read; at most one line is looked at."""
        try:
            lines = spark.read.text(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        lines.limit(1).collect()
        return True


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Each distinct header line and the files that have it; empty files have none.

    A task for every split of a file reads a few lines and stops.
    """

    # A function of its own call travels to workers with its code.
    def first_line(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch["start"].iloc[0] != 0:
                return
            filled = batch[batch["value"].str.strip() != ""]
            if len(filled):
                yield filled[["file", "value"]].iloc[:1]
                return

    lines = spark.read.text(path)
    place = lines.metadataColumn("_metadata")
    told = lines.select("value", place["file_path"].alias("file"), place["file_block_start"].alias("start"))
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    alone = {
        # So that no task gets two files.
        "spark__sql__files__openCostInBytes": whole,
        "spark__sql__execution__arrow__maxRecordsPerBatch": _FEW_LINES,
    }
    with settings(spark, **alone):
        found = told.mapInPandas(first_line, "file string, value string").collect()
    groups: dict[str, list[str]] = {}
    for row in found:
        groups.setdefault(row["value"].lstrip("﻿").strip(), []).append(plain_path(row["file"]))
    return {line: sorted(files) for line, files in groups.items()}


def locate(spark: SparkSession, sources: Iterable[TextSource]) -> TextSource:
    """The first source, in the order given, that has files.

    An error other than a missing path is raised as it is.
    """
    absent = []
    for source in sources:
        if source.present(spark):
            return source
        absent.append(f"{source.name} ({source.path})")
    raise FileNotFoundError(f"no source has files: {', '.join(absent) or 'none given'}")
