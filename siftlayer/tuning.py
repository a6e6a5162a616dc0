"""Session settings that the jobs depend on: shuffle width and method size.

AQE merges shuffle partitions that turn out small but cannot split one that
feeds an aggregate, so the width has to be large enough beforehand: 200 of them
would hold half a terabyte each for 100 TB of input.

Typing a wide record makes a large projection.  Whole-stage code generation
puts it into one method, and beyond 8000 bytes the JVM only interprets that
method, at a third of the speed or less.  With the limit set, Spark compiles
such a projection in smaller pieces instead.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_BYTES = "8000"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
TARGET_BYTES = 512 * 1024**2
_NO_ESTIMATE = 2**60


def scanned_bytes(df: DataFrame) -> int | None:
    """Spark's size estimate for a frame, or None where it has none."""
    if not hasattr(df, "_jdf"):  # a remote session keeps its plans to itself
        return None
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _NO_ESTIMATE else None


def shuffle_width(
    size: int | None, at_least: int, target: int = TARGET_BYTES, most: int | None = None
) -> int:
    """Partitions of about ``target`` bytes, never fewer than ``at_least``.

    ``most`` bounds them where the driver could not keep the books of more; the
    partitions then get larger.
    """
    if size is None:
        return at_least
    wanted = -(-size // target)
    return max(at_least, wanted if most is None else min(most, wanted))


@dataclass(frozen=True)
class Width:
    """How wide the shuffles of a job get.

    ``partitions`` says it outright.  Else it follows ``input_bytes``, or Spark's
    estimate where that is not given.
    """

    partitions: int | None = None
    input_bytes: int | None = None
    target_bytes: int = TARGET_BYTES
    most: int | None = None

    def of(self, df: DataFrame, growth: float, at_least: int) -> int:
        if self.partitions is not None:
            return self.partitions
        size = scanned_bytes(df) if self.input_bytes is None else self.input_bytes
        if size is None:
            log.warning("no size estimate for the input: %s shuffle partitions", at_least)
            return at_least
        return shuffle_width(int(size * growth), at_least, self.target_bytes, self.most)


def limit_method_size(spark: SparkSession) -> None:
    """Set the method limit for the whole session, for plans that run lazily."""
    spark.conf.set(METHOD_LIMIT, METHOD_BYTES)


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Run a block with session settings; ``__`` stands for the dots of a name."""
    wanted = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _key(name: str) -> str:
    return name.replace(".", "__")


@contextmanager
def tuned_for(df: DataFrame, growth: float = 1.0, width: Width = Width()) -> Iterator[None]:
    """Run a block with settings that suit a job over ``df``.

    Shuffles get wide enough for its size times ``growth``; the session's own
    width is raised where needed, and lowered only by ``width.partitions``.  All
    settings are put back.
    """
    spark: SparkSession = df.sparkSession
    at_least = int(spark.conf.get(SHUFFLE_PARTITIONS))
    wanted = width.of(df, growth, at_least)
    if wanted != at_least:
        log.info("shuffle partitions for this job: %s instead of %s", wanted, at_least)
    with settings(spark, **{_key(SHUFFLE_PARTITIONS): wanted, _key(METHOD_LIMIT): METHOD_BYTES}):
        yield


@contextmanager
def file_size(spark: SparkSession, target: int | None) -> Iterator[None]:
    """Run a block in which AQE aims at shuffle partitions of ``target`` bytes, if given."""
    with settings(spark, **({} if target is None else {_key(ADVISORY_BYTES): target})):
        yield


@contextmanager
def open_files(spark: SparkSession, most: int | None) -> Iterator[None]:
    """Run a block in which a task writes up to ``most`` partitions side by side, if given.

    A task sorts its rows by partition otherwise, which holds all of them in memory.
    """
    with settings(spark, **({} if most is None else {_key(OPEN_FILES): most})):
        yield
