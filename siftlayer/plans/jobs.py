"""The jobs: each reads a source or a layer table and writes the next layer."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import SparkSession

from siftlayer.plans import trips
from siftlayer.sinks import append_partitioned, recluster_table, replace_table
from siftlayer.sources import TextSource, locate, read_snapshot, read_table
from siftlayer.tuning import Width, tuned_for

# Typed rows in a shuffle take about this many times the bytes of the
# compressed text columns they come from.
_TYPED_GROWTH = 2.0

# Gold reads 7 of 26 silver columns and its tasks pre-aggregate them; even with
# as many groups as rows no more than about this share reaches the shuffle.
_GOLD_SHARE = 0.4


@dataclass(frozen=True)
class Layers:
    """Catalog names of the three tables and, optionally, a folder to keep them in."""

    bronze: str
    silver: str
    gold: str
    folder: str | None = None

    def location(self, layer: str) -> str | None:
        return None if self.folder is None else f"{self.folder.rstrip('/')}/{layer}"


@dataclass(frozen=True)
class Options:
    """How the jobs treat bad text, copies, later columns, files, sums and gold's layout."""

    on_error: str = "null"
    keep: str = "first"
    extra: str = "drop"  # columns beyond the schema: "drop" or "carry" to silver
    bronze_mode: str = "append"  # or "overwrite"
    rebalance: bool | None = None
    file_bytes: int | None = None  # of shuffled rows, with rebalance
    written_bytes: int | None = None  # of bronze files on disk; goes before rebalance
    scale: int | None = None
    count_type: str = "int"  # or "bigint"
    optimize: bool = True
    curve: str = "morton"
    width: Width = Width()


class Stage(Enum):
    """The stages in the order in which they build on each other."""

    BRONZE = "bronze"
    SILVER = "silver"
    GOLD = "gold"


@dataclass(frozen=True)
class Outcome:
    """What became of one stage: its rows where it counts them, or its error."""

    stage: Stage
    seconds: float
    rows: tuple[int, int] | None = None
    error: Exception | None = None

    @property
    def done(self) -> bool:
        return self.error is None


@dataclass
class Report:
    """Outcomes of the stages that ran, in order; filled while :func:`run` runs."""

    outcomes: list[Outcome] = field(default_factory=list)

    def last(self, stage: Stage) -> Outcome | None:
        return next((o for o in reversed(self.outcomes) if o.stage is stage), None)


def ingest(
    spark: SparkSession,
    layers: Layers,
    sources: Sequence[TextSource],
    options: Options = Options(),
) -> None:
    """Write the whole source to bronze: one scan, no shuffle unless rebalanced or large."""
    raw = locate(spark, sources).scan(spark, trips.RAW)
    with tuned_for(raw, width=options.width):
        append_partitioned(
            trips.to_bronze(raw, options.on_error),
            layers.bronze,
            trips.PARTITIONS,
            layers.location("bronze"),
            options.rebalance,
            options.file_bytes,
            options.bronze_mode,
            options.written_bytes,
        )


def refine(
    spark: SparkSession, layers: Layers, options: Options = Options()
) -> tuple[int, int]:
    """Rebuild silver from bronze; return rows in and rows out.

    Both counts are of parquet files, which reads their footers only: of the
    files that silver was made from, whatever arrived meanwhile, and of silver's.
    Counters inside the job would count the rows of a task again when its
    executor is lost.
    """
    bronze = read_snapshot(spark, layers.bronze, partitions=False)
    silver = trips.to_silver(bronze, options.on_error, options.keep, options.extra)
    with tuned_for(bronze, _TYPED_GROWTH, options.width):
        replace_table(silver, layers.silver, layers.location("silver"))
    return bronze.count(), read_table(spark, layers.silver).count()


def publish(spark: SparkSession, layers: Layers, options: Options = Options()) -> None:
    """Rebuild gold from silver, then cluster its files by zone, year and month."""
    silver = read_table(spark, layers.silver)
    with tuned_for(silver, _GOLD_SHARE, options.width):
        replace_table(
            trips.to_gold(silver, options.scale, options.count_type),
            layers.gold,
            layers.location("gold"),
        )
    if options.optimize:
        recluster_table(
            spark,
            layers.gold,
            trips.GOLD_ORDER,
            options.curve,
            location=layers.location("gold"),
            width=options.width,
        )


def run(
    spark: SparkSession,
    layers: Layers,
    sources: Sequence[TextSource] = (),
    stages: Iterable[Stage] = tuple(Stage),
    options: Options = Options(),
    report: Report | None = None,
) -> Report:
    """Run the chosen stages in order and stop at the first that fails.

    A stage after a failed one would work on the previous contents of its input.
    The error is raised as it is; a ``report`` passed in then holds the outcomes
    of the finished stages and of the failed one.
    """
    report = Report() if report is None else report
    work = {
        Stage.BRONZE: lambda: ingest(spark, layers, sources, options),
        Stage.SILVER: lambda: refine(spark, layers, options),
        Stage.GOLD: lambda: publish(spark, layers, options),
    }
    for stage in stages:
        start = time.perf_counter()
        try:
            rows = work[stage]()
        except Exception as error:
            report.outcomes.append(Outcome(stage, time.perf_counter() - start, error=error))
            raise
        report.outcomes.append(Outcome(stage, time.perf_counter() - start, rows))
    return report
