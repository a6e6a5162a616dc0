"""Layer tables: parquet files registered in the session catalog."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlayer.operators.layout import (
    file_position,
    order_by_morton_key,
    order_by_range,
    quantile_bounds,
)
from siftlayer.sinks.sizing import bytes_a_row, dealt_to_files
from siftlayer.sources.tables import (
    current_version,
    is_version,
    partition_columns,
    qualified,
    read_table,
    table_details,
    table_properties,
    view_of,
)
from siftlayer.tuning import Width, file_size, open_files, scanned_bytes, tuned_for

log = logging.getLogger(__name__)

# Below a table's folder; readers of the folder itself skip names like this.
_VERSIONS = "/_versions/"
_SPREAD = "_spread_of_row"
# A rebalanced task holds few partitions; rows of any beyond these are sorted first.
_OPEN_FILES = 32
# Rows beyond so many estimated bytes are rebalanced unless told otherwise: each task
# would sort its share by partition, and write a small file to nearly every partition.
_SORTED_BYTES = 256 * 1024**2
# Types that no hash aggregate keeps the least of.
_UNSIZED = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
# Ranges of up to so many files are sent to every task.
_FEW_FILES = 100_000


def _default_location(spark: SparkSession, name: str) -> str:
    *qualifier, table = name.split(".")
    database = ".".join(qualifier) or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _nullable(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema.fields]


# Properties that a statement of their own sets.
_RESERVED = ("comment", "external", "location", "owner", "provider")


# Appending.


def _register_folder(
    spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str], location: str
) -> None:
    """Make a table of the files that already lie in a folder, if there are any."""
    try:
        found = spark.read.option("mergeSchema", True).parquet(location).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return
        raise
    missing = [c for c in partition_by if c not in found.names]
    if missing:
        raise ValueError(f"the files in {location} are not partitioned by {missing}")
    fields = [f for f in found.fields if f.name not in partition_by]
    fields += [df.schema[c] for c in partition_by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({parts})"
        f" LOCATION {_quoted(location)}"
    )
    spark.catalog.recoverPartitions(name)


def _grow_schema(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Add the columns the table lacks, pad the ones the frame lacks."""
    schema = spark.table(name).schema
    existing = {f.name.lower(): f for f in schema.fields}
    arriving = {f.name.lower(): f for f in df.schema.fields}
    for key in existing.keys() & arriving.keys():
        if existing[key].dataType != arriving[key].dataType:
            raise TypeError(
                f"column {existing[key].name!r} of {name} is "
                f"{existing[key].dataType.simpleString()}, the new rows have "
                f"{arriving[key].dataType.simpleString()}"
            )
    added = [f for key, f in arriving.items() if key not in existing]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        schema = spark.table(name).schema
    return df.select(
        *(
            F.col(f.name)
            if f.name.lower() in arriving
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def append_partitioned(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str],
    location: str | None = None,
    rebalance: bool | None = None,
    file_bytes: int | None = None,
    mode: str = "append",
    written_bytes: int | None = None,
) -> None:
    """Append rows to a partitioned table, creating it on first use.

    Columns may come and go between appends: missing values read as null.  A
    folder that holds files but is no table yet is registered with them first;
    existing files are never removed.  Without ``rebalance`` the write needs no
    shuffle; each task sorts its rows by partition and writes one file per partition
    it holds.  ``rebalance`` adds one shuffle for fewer and larger files: it gathers
    the rows of a partition and lets AQE split partitions beyond ``file_bytes`` of
    shuffled rows.  Its tasks write the few partitions they hold side by side and sort
    nothing.  Left out, Spark's estimate of the rows decides.  ``written_bytes`` deals rows
    to files of that size on disk instead (see :mod:`siftlayer.sinks.sizing`), for
    which the rows are counted first.  ``mode="overwrite"`` replaces all contents, as
    :func:`replace_table` does.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if rebalance is None:
        rebalance = written_bytes is None and (scanned_bytes(df) or 0) > _SORTED_BYTES
    together = _OPEN_FILES if rebalance and written_bytes is None else None

    def arranged(rows: DataFrame) -> DataFrame:
        if written_bytes is not None:
            table = read_table(spark, name) if exists else None
            stored = [c for c in rows.columns if c not in partition_by]
            size = bytes_a_row(rows, table, stored)
            return rows if size is None else dealt_to_files(rows, partition_by, max(1, round(written_bytes / size)))
        return rows.hint("rebalance", *partition_by) if rebalance else rows

    if mode == "overwrite":
        rows = arranged(df)
        with file_size(spark, file_bytes), open_files(spark, together):
            replace_table(rows, name, location, partition_by)
        return
    if mode != "append":
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    folder = (location or _default_location(spark, name)).rstrip("/")
    if not exists:
        _register_folder(spark, df, name, partition_by, folder)
        exists = spark.catalog.tableExists(name)
    target, rows = current_version(spark, name) if exists else name, df
    if exists:
        rows = _grow_schema(spark, df, target)
        grown = target != name and len(rows.columns) > len(spark.table(name).columns)
    rows = arranged(rows)
    writer = rows.write.format("parquet").mode("append").partitionBy(*partition_by)
    with file_size(spark, file_bytes), open_files(spark, together):
        (writer if exists else writer.option("path", folder)).saveAsTable(target)
    if exists and grown:
        spark.sql(f"ALTER VIEW {name} AS {view_of(target)}")


# Replacing.
#
# A name that replace_table makes is a view of one table, the current version.  ALTER
# VIEW switches it in one call to the catalog, whatever changes: rows, columns, types
# or partitioning.  (CREATE OR REPLACE VIEW would drop the view and create another.)


def _base(spark: SparkSession, name: str, location: str | None, details: dict[str, str] | None) -> str:
    """The folder below which the versions of a table go.

    It is the given one, or where the table's versions lie already.  A managed
    table's own folder goes when the table is dropped, so its versions lie beside it.
    """
    if location is not None:
        base = location.rstrip("/")
    elif details is None:
        return _default_location(spark, name)
    else:
        base = details["Location"].partition(_VERSIONS)[0].rstrip("/")
    if details is not None and details["Type"] == "MANAGED":
        own = details["Location"].rstrip("/")
        if base == own or base.startswith(f"{own}/") or base == own.partition(":")[2]:
            return f"{base}_external"
    return base


def _kept_properties(spark: SparkSession, name: str) -> dict[str, str]:
    kept = table_properties(spark, name).items()
    return {k: v for k, v in kept if not k.startswith(("transient_", "spark.sql.")) and k not in _RESERVED}


def _described(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The frame with the column comments of a table."""
    comments = {c.name: c.description for c in spark.catalog.listColumns(name) if c.description}
    for column in df.columns:
        if column in comments and "comment" not in df.schema[column].metadata:
            df = df.withMetadata(column, df.schema[column].metadata | {"comment": comments[column]})
    return df


def _forget(spark: SparkSession, name: str, *kept: str) -> None:
    """Take versions of a name out of the catalog but for some; their files stay."""
    database, _, table = qualified(spark, name).rpartition(".")
    for found in spark.catalog.listTables(database, f"{table}_*"):
        version = f"{database}.{found.name}"
        if found.tableType == "EXTERNAL" and is_version(version, name) and version not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {version}")


def replace_table(
    df: DataFrame,
    name: str,
    location: str | None = None,
    partition_by: Sequence[str] | None = None,
) -> str:
    """Replace contents and schema of a table; return the folder of the new version.

    Rows go to a new folder first, and only once they are all there does the name
    point to them.  A failed write leaves the table as it was, and ``df`` may read
    the table it replaces.  Comments and properties stay.  ``partition_by`` left
    out keeps the table's partitioning, as far as the rows have those columns.

    A name made here is a view of its current version, an external table called
    like it with a suffix.  One call to the catalog switches the view, so the name is
    never absent, whatever becomes of schema and partitioning, and a crash leaves it
    on one version or the other.  The version before stays in the catalog for
    readers that have begun; older entries go, and the files of all stay for the
    caller's retention job.

    A name that is a table already keeps being one where it is external,
    unpartitioned and of the same schema: its location changes, in one statement.
    Any other table is dropped and turned into a view, this one time: in between
    the name is absent, and a managed table's old files go with its entry.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    version = current_version(spark, name) if exists else name
    details = table_details(spark, version) if exists else None
    if details is not None and details["Type"] not in ("MANAGED", "EXTERNAL"):
        raise ValueError(f"{name} is a view that shows no version of a table: it cannot be replaced")
    before = partition_columns(spark, version) if exists else []
    if partition_by is None:
        partition_by = [c for c in before if c in df.columns]
    folder = f"{_base(spark, name, location, details)}{_VERSIONS}{uuid.uuid4().hex}"
    if (
        details is not None
        and version == name
        and not partition_by
        and not before
        and details["Type"] == "EXTERNAL"
        and details["Provider"].lower() == "parquet"
        and _nullable(spark.table(name).schema) == _nullable(df.schema)
    ):
        df.write.format("parquet").mode("errorifexists").save(folder)
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(folder)}")
        spark.catalog.refreshTable(name)
        log.info("table %s now reads %s", name, folder)
        return folder
    fresh = f"{qualified(spark, name)}_{uuid.uuid4().hex}"
    rows = _described(spark, df, name) if exists else df
    writer = rows.write.format("parquet").option("path", folder)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(fresh)
    if exists and version != name:
        spark.sql(f"ALTER VIEW {name} AS {view_of(fresh)}")
    else:
        told = f" COMMENT {_quoted(details['Comment'])}" if details and details.get("Comment") else ""
        if exists:
            kept = [f"{_quoted(k)} = {_quoted(v)}" for k, v in _kept_properties(spark, name).items()]
            told += f" TBLPROPERTIES ({', '.join(kept)})" if kept else ""
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE VIEW {name}{told} AS {view_of(fresh)}")
    _forget(spark, name, fresh, version)
    log.info("table %s now shows %s in %s", name, fresh, folder)
    return folder


def recluster_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str],
    curve: str = "morton",
    bits: int = 8,
    location: str | None = None,
    partitions: int | None = None,
    width: Width = Width(),
) -> str:
    """Rewrite a table so that its files cover narrow ranges of ``columns``.

    Small files are merged on the way.  ``curve`` is ``"morton"`` (Z-order) or
    ``"linear"``.  The rows stay the same.
    """
    df = read_table(spark, name)
    spread = file_position()
    if curve == "linear":
        placed = order_by_range(df, columns, spread, partitions)
    elif curve == "morton":
        bounds = quantile_bounds(df, columns, bits)
        placed = order_by_morton_key(df, columns, bounds, spread, partitions)
    else:
        raise ValueError(f"curve must be 'morton' or 'linear', not {curve!r}")
    with tuned_for(df, width=width):
        return replace_table(placed, name, location)


def _file_ranges(table: DataFrame, parts: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The least and the greatest row of each file by ``columns``, nulls first.

    A least row as such would be found by sorting all rows of a task.  Column by
    column it is a hash aggregate: the least of the first, then that of the next among
    the rows that have it, and so on.  Text has no such aggregate.
    """
    place = table.metadataColumn("_metadata")["file_path"].alias("_file")
    if any(isinstance(table.schema[c].dataType, _UNSIZED) for c in columns):
        row = F.struct(*columns)
        return table.groupBy(*parts, place).agg(F.min(row).alias("_least"), F.max(row).alias("_most"))
    rows = table.select(*parts, place, *(F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)))
    few = len(table.inputFiles()) <= _FEW_FILES
    ends = rows.groupBy(*parts, "_file").agg(*_ends(0, F.lit(True), F.lit(True)))
    for i in range(1, len(columns)):
        known = F.broadcast(ends.drop(*parts)) if few else ends.drop(*parts)
        least = [F.when(~F.col(f"_blank{j}"), F.col(f"_low{j}")) for j in range(i)]
        low = reduce(and_, (F.col(f"_c{j}").eqNullSafe(end) for j, end in enumerate(least)))
        high = reduce(and_, (F.col(f"_c{j}").eqNullSafe(F.col(f"_high{j}")) for j in range(i)))
        found = rows.join(known, "_file").groupBy(*parts, "_file").agg(*_ends(i, low, high))
        ends = found.join(known, "_file")
    numbers = range(len(columns))
    return ends.select(
        *parts,
        F.struct(*(F.when(~F.col(f"_blank{i}"), F.col(f"_low{i}")).alias(f"_c{i}") for i in numbers)).alias("_least"),
        F.struct(*(F.col(f"_high{i}").alias(f"_c{i}") for i in numbers)).alias("_most"),
    )


def _ends(i: int, low: Column, high: Column) -> list[Column]:
    """The ends of column ``i`` among the rows that begin like the least and the greatest row."""
    value = F.col(f"_c{i}")
    return [
        F.max(low & value.isNull()).alias(f"_blank{i}"),
        F.min(F.when(low, value)).alias(f"_low{i}"),
        F.max(F.when(high, value)).alias(f"_high{i}"),
    ]


def _overlapping(table: DataFrame, parts: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The partitions in which the range of some file reaches into that of another.

    A sweep over the files of a partition in the order of their least rows: a file
    overlaps when one before it goes beyond its least row.  Files that share a
    bound do not overlap.
    """
    ranges = _file_ranges(table, parts, columns)
    before = Window.partitionBy(*parts).orderBy("_least", "_most").rowsBetween(Window.unboundedPreceding, -1)
    swept = ranges.withColumn("_reached", F.max("_most").over(before))
    return swept.where(F.col("_reached") > F.col("_least")).select(*parts).distinct()


def recluster_partitions(
    spark: SparkSession, name: str, columns: Sequence[str], width: Width = Width()
) -> list[tuple]:
    """Sort the partitions whose files overlap in ``columns``; return the values of those rewritten.

    All other partitions keep their files, so after an append only what it touched is
    written again.  A rewritten partition goes to a new folder, sorted, and one
    statement moves its location; readers find every partition in its old or its
    new form.  Copies of a key are spread over several files.  The partition of null
    values stays as it is, as no statement can name it.  Old files stay for the
    caller's retention job.
    """
    version = current_version(spark, name)
    parts = partition_columns(spark, version)
    if not parts:
        raise ValueError(f"{name} has no partitions: use recluster_table")
    table = spark.read.table(version)
    named = reduce(and_, (F.col(p).isNotNull() for p in parts))
    found = _overlapping(table, parts, columns).where(named).collect()
    if not found:
        return []
    schema = T.StructType([table.schema[p] for p in parts])
    rows = table.withColumn(_SPREAD, file_position()).join(F.broadcast(spark.createDataFrame(found, schema)), parts)
    base = table_details(spark, version)["Location"].partition(_VERSIONS)[0].rstrip("/")
    folder = f"{base}{_VERSIONS}{uuid.uuid4().hex}"
    with tuned_for(table, width=width):
        placed = order_by_range(rows, [*parts, *columns], F.col(_SPREAD)).drop(_SPREAD)
        placed.write.partitionBy(*parts).parquet(folder)
    written = spark.read.schema(table.schema).parquet(folder)
    place = F.regexp_replace(written.metadataColumn("_metadata")["file_path"], "/[^/]*$", "").alias("_place")
    for row in written.select(*parts, place).distinct().collect():
        spec = ", ".join(f"`{p}` = {_quoted(str(row[p]))}" for p in parts)
        spark.sql(f"ALTER TABLE {version} PARTITION ({spec}) SET LOCATION {_quoted(unquote(row['_place']))}")
    spark.catalog.refreshTable(version)
    return sorted(tuple(row) for row in found)
