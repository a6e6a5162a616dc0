"""Catalog tables as sources."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlayer.workspace import shared_folder

# Formats whose files a frame can name one by one and read without table options.
_PINNED = ("parquet", "orc")

# Partition values of up to this many folders are sent to every task.
_FEW_FOLDERS = 100_000
_FOLDER = "_folder_of_file"


def table_details(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table: ``Location``, ``Type``, ``Provider`` and so on.

    Of a temporary view it only says that it is a view.
    """
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    titles = [row["col_name"] for row in rows]
    if "# Detailed Table Information" not in titles:
        return {"Type": "VIEW"}
    start = titles.index("# Detailed Table Information")
    return {row["col_name"]: row["data_type"] for row in rows[start + 1 :] if row["col_name"]}


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def qualified(spark: SparkSession, name: str) -> str:
    """A table's name with its database."""
    return name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"


def view_of(version: str) -> str:
    """The text of the view that publishes a version under the table's name."""
    return f"SELECT * FROM {version}"


def is_version(table: str, name: str) -> bool:
    """Whether a table is called like a version of ``name``."""
    own = re.escape(name.rpartition(".")[2].lower())
    return re.fullmatch(own + "_[0-9a-f]{32}", table.rpartition(".")[2].lower()) is not None


def current_version(spark: SparkSession, name: str) -> str:
    """The table that holds the rows of ``name``: itself, or what its published view shows."""
    if spark.catalog.getTable(name).tableType != "VIEW":
        return name
    text = table_details(spark, name).get("View Text", "")
    shown = text.rpartition(" ")[2]
    return shown if text == view_of(shown) and is_version(shown, name) else name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a table by its one- to three-part name; of a published view, the table it shows.

    So ``_metadata`` can be asked for, which views hide.
    """
    return spark.read.table(current_version(spark, name))


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def plain_path(uri: str) -> str:
    """A file's path in the form that readers take, with nothing that reads as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _pinned(spark: SparkSession, name: str, provider: str, partitions: bool) -> DataFrame:
    table = spark.read.table(name)
    parts = partition_columns(spark, name)
    stored = T.StructType([f for f in table.schema.fields if f.name not in parts])
    shown = [f.name for f in table.schema.fields if partitions or f.name not in parts]
    files = table.inputFiles()
    if not files:
        return spark.createDataFrame([], table.schema).select(*shown)
    rows = spark.read.schema(stored).format(provider).load([plain_path(uri) for uri in files])
    if parts and partitions:
        # The values are the catalog's; a folder need not be called like its partition.
        folder = _folder(table.metadataColumn("_metadata")["file_path"]).alias(_FOLDER)
        found = table.select(folder, *parts).distinct().collect()
        fields = [T.StructField(_FOLDER, T.StringType()), *(table.schema[p] for p in parts)]
        places = spark.createDataFrame(found, T.StructType(fields))
        own = rows.withColumn(_FOLDER, _folder(rows.metadataColumn("_metadata")["file_path"]))
        rows = own.join(F.broadcast(places) if len(found) <= _FEW_FOLDERS else places, _FOLDER)
    return rows.select(*shown)


def read_snapshot(spark: SparkSession, name: str, partitions: bool = True) -> DataFrame:
    """A table as it is now: every action on the frame reads the same rows.

    The files are those that the catalog's scan of the table resolves to, wherever
    its partitions lie; they are listed once, when the frame is made.  Partition
    columns take one more look at the footers, and are left out with
    ``partitions=False``.  What has no parquet or ORC files of its own, such as a
    view, is copied once to the shared folder instead.
    """
    version = current_version(spark, name)
    details = table_details(spark, version)
    provider = details.get("Provider", "").lower()
    if details["Type"] in ("MANAGED", "EXTERNAL") and provider in _PINNED:
        return _pinned(spark, version, provider, partitions)
    rows = spark.read.table(name)
    if not partitions:
        rows = rows.drop(*partition_columns(spark, version))
    path = f"{shared_folder(spark)}/snapshot"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
