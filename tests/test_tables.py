"""Sources, sinks, layout and jobs on small tables in a temporary folder."""

import threading
import uuid

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from siftlayer import tuning
from siftlayer.operators.layout import file_position, order_by_range, quantile_bounds
from siftlayer.plans import jobs, trips
from siftlayer.plans.jobs import Stage
from siftlayer.plans.schemas import BRONZE, GOLD, SILVER, TRIP_FILE
from siftlayer.sinks import append_partitioned, recluster_partitions, recluster_table, replace_table, tables
from siftlayer.sources import TextSource, locate, read_snapshot
from siftlayer.sources.tables import current_version, partition_columns, table_details
from siftlayer.workspace import shared_folder
from tests.fixtures import NEGATIVE_FARE, VALID, arrived, bronze, trip

AB = TRIP_FILE[:2]


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


@pytest.fixture
def layers(tmp_path):
    suffix = uuid.uuid4().hex
    return jobs.Layers(f"b_{suffix}", f"s_{suffix}", f"g_{suffix}", str(tmp_path / "layers"))


def _csv(folder, text, file="a.csv"):
    folder.mkdir(exist_ok=True)
    (folder / file).write_text(text)
    return f"{folder}/*.csv"


# --- sources ---------------------------------------------------------------


def test_columns_go_by_position_and_ragged_lines_are_repaired(spark, tmp_path):
    path = _csv(tmp_path / "in", 'x,y\na,1\nshort\nlong,2,surplus\n,\n"",3\n')
    assert AB.names == ["vendor_id", "tpep_pickup_datetime"]
    rows = [tuple(r) for r in TextSource("in", path).scan(spark, AB).collect()]
    assert rows == [("a", "1"), ("short", None), ("long", "2"), (None, None), (None, "3")]


def test_header_check_refuses_other_columns(spark, tmp_path):
    path = _csv(tmp_path / "in", "tpep_pickup_datetime,vendor_id\n1,a\n")
    assert TextSource("in", path).scan(spark, AB).first()[0] == "1"
    with pytest.raises(Exception, match="(?i)header"):
        TextSource("in", path, check_header=True).scan(spark, AB).collect()


def test_the_first_source_with_files_is_read(spark, tmp_path):
    one = TextSource("one", _csv(tmp_path / "one", "v,t\na,1\n"))
    two = TextSource("two", _csv(tmp_path / "two", "v,t\nb,2\n"))
    absent = TextSource("absent", f"{tmp_path}/absent/*.csv")
    assert locate(spark, [absent, two, one]) is two
    assert two.scan(spark, AB).first()[0] == "b"
    with pytest.raises(FileNotFoundError, match="absent"):
        locate(spark, [absent])
    with pytest.raises(FileNotFoundError, match="none given"):
        locate(spark, [])


def test_other_errors_do_not_move_on(spark, tmp_path):
    good = TextSource("good", _csv(tmp_path / "good", "v,t\na,1\n"))
    with pytest.raises(Exception, match="(?i)scheme"):
        locate(spark, [TextSource("odd", "nosuchscheme://x/*.csv"), good])


# --- sinks -----------------------------------------------------------------


def test_append_grows_and_pads_columns(spark, name, tmp_path):
    location = str(tmp_path / name)
    first = spark.createDataFrame([("a", 2024, 1)], "v string, y int, m int")
    wider = spark.createDataFrame([(2024, "new", 1, "b")], "y int, extra string, m int, v string")
    for batch in (first, wider, first):
        append_partitioned(batch, name, ["y", "m"], location)
    rows = {(r["v"], r["extra"]): r["count"]
            for r in spark.table(name).groupBy("v", "extra").count().collect()}
    assert rows == {("a", None): 2, ("b", "new"): 1}
    with pytest.raises(TypeError, match="'v'.*string.*int"):
        append_partitioned(first.withColumn("v", F.lit(1)), name, ["y", "m"], location)


@pytest.mark.parametrize("rebalance", [None, True])
def test_unreadable_pickups_go_to_the_null_partition(spark, name, tmp_path, rebalance):
    rows = bronze(spark, VALID, trip(tpep_pickup_datetime="soon"))
    delivery = trips.to_bronze(rows.select(*trips.RAW.names))
    location = tmp_path / name
    append_partitioned(delivery, name, trips.PARTITIONS, str(location), rebalance)
    assert (location / "pickup_year=__HIVE_DEFAULT_PARTITION__").exists()
    table = spark.table(name)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in BRONZE]
    assert table.filter("pickup_year is null").count() == 1
    assert table.filter("pickup_year = 2025 and pickup_month = 3").count() == 1


def test_rebalance_writes_one_file_per_small_partition(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).select(F.col("id"), (F.col("id") % 2).alias("p"))
    files = {}
    for rebalance in (None, True):
        name = f"t_{uuid.uuid4().hex}"
        append_partitioned(df, name, ["p"], str(tmp_path / name), rebalance)
        files[rebalance] = len(list((tmp_path / name).rglob("*.parquet")))
    assert files == {None: 16, True: 2}


def test_replace_changes_schema_and_keeps_readers_and_failures_safe(spark, name, tmp_path):
    location = str(tmp_path / name)
    replace_table(spark.range(3), name, location)
    old = spark.table(name)
    replace_table(spark.range(5).withColumn("x", F.lit("y")), name, location)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 5
    assert old.count() == 3
    # the frame may read what it replaces
    replace_table(spark.table(name).filter("id > 0"), name, location)
    assert spark.table(name).count() == 4
    with pytest.raises(Exception, match="broken"):
        replace_table(spark.range(2).select(F.raise_error(F.lit("broken"))), name, location)
    assert spark.table(name).count() == 4


def test_default_location_is_in_the_database_folder(spark, name):
    folder = replace_table(spark.range(1), name)
    assert f"/{name}/_versions/" in folder
    assert spark.table(name).count() == 1


def _start(spark, name, tmp_path, state):
    """A table with two rows in one of the states in which a sink may find it."""
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    writer = rows.write.format("parquet")
    if "partitioned" in state:
        writer = writer.partitionBy("p")
    if "external" in state:
        writer = writer.option("path", str(tmp_path / f"{name}_own"))
    if state != "missing":
        writer.saveAsTable(name)
    return rows


STATES = ["missing", "managed", "external", "managed partitioned", "external partitioned"]


@pytest.mark.parametrize("state", STATES)
@pytest.mark.parametrize("wider", [False, True])
def test_replace_from_every_state(spark, name, tmp_path, state, wider):
    rows = _start(spark, name, tmp_path, state)
    new = rows.limit(1).withColumn("more", F.lit(1.5)) if wider else rows.limit(1)
    for _ in range(2):
        replace_table(new, name)
        assert sorted(spark.table(name).columns) == sorted(new.columns)
        assert spark.table(name).select(new.columns).collect() == new.collect()
        spark.catalog.refreshTable(name)
        assert spark.table(name).count() == 1
    version = current_version(spark, name)
    assert partition_columns(spark, version) == (["p"] if "partitioned" in state else [])
    if "external" in state:  # it stays where it was
        assert f"{tmp_path}/{name}_own/_versions/" in table_details(spark, version)["Location"]
        assert len(list((tmp_path / f"{name}_own").rglob("*.parquet"))) >= 3


@pytest.mark.parametrize("state", STATES[1:])
def test_recluster_and_failed_replace_from_every_state(spark, name, tmp_path, state):
    rows = _start(spark, name, tmp_path, state)
    with pytest.raises(Exception, match="broken"):
        replace_table(rows.withColumn("id", F.raise_error(F.lit("broken")).cast("int")), name)
    assert spark.table(name).count() == 2
    recluster_table(spark, name, ["id"])
    assert {tuple(r) for r in spark.table(name).select("id", "p").collect()} == {(1, "a"), (2, "b")}


@pytest.mark.parametrize("state", STATES)
def test_append_never_removes_files(spark, name, tmp_path, state):
    if state in ("managed", "external"):
        pytest.skip("append_partitioned works on partitioned tables")
    rows = _start(spark, name, tmp_path, state)
    for number in (1, 2):
        append_partitioned(rows, name, ["p"])
        assert spark.table(name).count() == 2 * number + (0 if state == "missing" else 2)


def test_append_to_a_folder_that_is_no_table(spark, name, tmp_path):
    location = str(tmp_path / name)
    rows = spark.createDataFrame([(1, 7), (2, 8)], "id int, p int")
    append_partitioned(rows.withColumn("more", F.lit("x")), name, ["p"], location)
    spark.sql(f"DROP TABLE {name}")
    append_partitioned(rows.where("p = 8"), name, ["p"], location)
    assert spark.table(name).count() == 3 and spark.table(name).where("p = 7").count() == 1
    plain = str(tmp_path / "plain")
    rows.write.parquet(plain)
    with pytest.raises(ValueError, match="not partitioned"):
        append_partitioned(rows.withColumnRenamed("p", "q"), f"{name}_2", ["q"], plain)


def test_overwrite_mode_and_then_append(spark, name, tmp_path):
    rows = spark.createDataFrame([(1, 7), (2, 8)], "id int, p int")
    location = str(tmp_path / name)
    for mode, count in (("append", 2), ("append", 4), ("overwrite", 2), ("append", 4)):
        append_partitioned(rows, name, ["p"], location, mode=mode)
        assert spark.table(name).count() == count
    with pytest.raises(ValueError, match="mode"):
        append_partitioned(rows, name, ["p"], location, mode="ignore")


def test_replace_keeps_comments_and_properties(spark, name, tmp_path):
    _start(spark, name, tmp_path, "external")
    spark.sql(f"COMMENT ON TABLE {name} IS 'the owner''s words'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('team' = 'harbour')")
    spark.sql(f"ALTER TABLE {name} ALTER COLUMN id COMMENT 'a number'")
    replace_table(spark.range(3).withColumn("x", F.lit(1)), name)
    details = table_details(spark, name)
    assert details["Comment"] == "the owner's words" and "team=harbour" in details["Table Properties"]
    assert {c.name: c.description for c in spark.catalog.listColumns(name)}["id"] == "a number"


class Lost(Exception):
    """Stands for a driver that is lost."""


def _statements(monkeypatch, spark, stop_before=None):
    """Count the statements that change the catalog; be lost before one of them."""
    seen, plain = [], type(spark).sql

    def sql(self, text, *args, **kwargs):
        if text.split()[0] in ("CREATE", "ALTER", "DROP"):
            if len(seen) == stop_before:
                raise Lost(text)
            seen.append(text)
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    return seen


def _replace(spark, name, number):
    """Rows of changing number, columns, types and partitioning."""
    columns = [("v", F.col("id") * 1.5), ("v", F.col("id").cast("string")), ("w", F.lit(number))]
    column, value = columns[number % 3]
    df = spark.range(number + 1).withColumn(column, value).withColumn("p", F.col("id") % 2)
    replace_table(df, name, partition_by=["p"] if number % 2 else [])


def test_the_name_is_there_while_its_schema_changes(spark, name):
    """A reader that asks for the name all the time, through changes of columns, types and partitioning."""
    _replace(spark, name, 0)
    stop, problems, counts = threading.Event(), [], []

    def read():
        other = spark.newSession()
        while not stop.is_set():
            try:
                counts.append(len(other.table(name).collect()))
            except Exception as error:  # noqa: BLE001 - any failure counts
                problems.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for number in range(1, 13):
            _replace(spark, name, number)
    finally:
        stop.set()
        reader.join()
    assert not problems
    assert len(set(counts)) > 2 and set(counts) <= set(range(1, 14)) and counts == sorted(counts)
    entries = [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]
    assert len(entries) == 3  # the name, the version shown and the one before


@pytest.mark.parametrize("state", ["missing", "external", "replaced"])
def test_a_crash_leaves_one_version_or_the_other(spark, tmp_path, monkeypatch, state):
    lost_at = 0
    while True:
        name = f"t_{uuid.uuid4().hex}"
        rows = _start(spark, name, tmp_path, "external" if state == "external" else "missing")
        if state == "replaced":
            for _ in range(2):
                replace_table(rows, name)
        new = rows.limit(1) if state == "external" else rows.limit(1).withColumn("x", F.lit(1))
        with monkeypatch.context() as patch:
            _statements(patch, spark, lost_at)
            try:
                replace_table(new, name)
                assert lost_at > 0
                return
            except Lost:
                pass
        if state == "missing":
            assert not spark.catalog.tableExists(name)
        else:
            assert spark.table(name).count() in (1, 2)
        replace_table(new, name)
        assert spark.table(name).count() == 1
        lost_at += 1


def test_a_view_of_others_is_not_replaced(spark, name):
    spark.sql(f"CREATE VIEW {name} AS SELECT 1 AS id")
    with pytest.raises(ValueError, match="is a view"):
        replace_table(spark.range(1), name)


def test_append_to_a_replaced_table_shows_new_columns(spark, name, tmp_path):
    rows = spark.createDataFrame([(1, 7)], "id int, p int")
    append_partitioned(rows, name, ["p"], str(tmp_path / name))
    append_partitioned(rows, name, ["p"], str(tmp_path / name), mode="overwrite")
    spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ('team' = 'harbour')")
    append_partitioned(rows.withColumn("more", F.lit("x")), name, ["p"], str(tmp_path / name))
    assert {(r["id"], r["more"]) for r in spark.table(name).collect()} == {(1, None), (1, "x")}
    assert spark.sql(f"SHOW TBLPROPERTIES {name} ('team')").first()["value"] == "harbour"


def test_readers_of_the_folder_do_not_see_versions(spark, name, tmp_path):
    location = str(tmp_path / name)
    for count in (1, 2):
        replace_table(spark.range(count), name, location)
    with pytest.raises(Exception, match="(?i)infer"):
        spark.read.parquet(location)


def test_rebalanced_files_follow_the_target_size(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.lit(1).alias("p"))
    files = {}
    for size in (1 << 20, 64 << 20):
        name = f"t_{uuid.uuid4().hex}"
        append_partitioned(df, name, ["p"], str(tmp_path / name), True, size)
        files[size] = len(list((tmp_path / name).rglob("*.parquet")))
    assert files[1 << 20] >= 4 and files[64 << 20] == 1


# --- layout ----------------------------------------------------------------


def _files_touched(spark, folder, condition):
    df = spark.read.parquet(folder)
    ranges = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        *(F.min(c).alias(f"lo_{c}") for c in "ab"), *(F.max(c).alias(f"hi_{c}") for c in "ab")
    )
    return ranges.filter(condition).count(), ranges.count()


def test_morton_order_lets_filters_on_any_column_skip_files(spark, tmp_path):
    df = spark.range(20_000).select(
        (F.hash("id") % 1000).alias("a"), (F.xxhash64("id") % 1000).cast("int").alias("b")
    )
    touched = {}
    for curve in ("morton", "linear"):
        name, location = f"t_{uuid.uuid4().hex}", str(tmp_path / curve)
        replace_table(df, name, location)
        folder = recluster_table(spark, name, ["a", "b"], curve, location=location, partitions=16)
        assert spark.table(name).exceptAll(df).isEmpty() and spark.table(name).count() == 20_000
        touched[curve] = [
            _files_touched(spark, folder, f"lo_{c} <= 700 and hi_{c} >= 700")[0] for c in "ab"
        ]
        assert _files_touched(spark, folder, "true")[1] == 16
    assert max(touched["morton"]) <= 8
    assert touched["linear"][0] <= 2 and touched["linear"][1] == 16


@pytest.mark.parametrize("curve", ["morton", "linear"])
def test_hot_value_is_split_over_files(spark, name, tmp_path, curve):
    """All rows are copies of one row but a few; no file may hold them all."""
    df = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7).cast("int").alias("a")
    )
    location = str(tmp_path / name)
    replace_table(df, name, location)
    folder = recluster_table(spark, name, ["a"], curve, location=location, partitions=8)
    sizes = [r[1] for r in spark.read.parquet(folder)
             .groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 9000 and max(sizes) < 9000 / 8 * 1.5
    assert spark.table(name).exceptAll(df).isEmpty()


def test_layout_of_nulls_dates_and_nothing(spark, name, tmp_path):
    rows = [(None, None, None), (1, "2024-01-01", 1.5), (2, "2023-01-01", float("nan"))]
    df = spark.createDataFrame(rows, "a int, d string, v double")
    df = df.withColumn("d", F.col("d").cast("date"))
    for batch in (df, df.limit(0)):
        replace_table(batch, name, str(tmp_path / name))
        recluster_table(spark, name, ["a", "d", "v"], location=str(tmp_path / name))
        assert spark.table(name).exceptAll(batch).isEmpty()
        assert spark.table(name).count() == batch.count()
    with pytest.raises(TypeError, match="cannot be ranked"):
        quantile_bounds(df.withColumn("s", F.lit("x")), ["s"], 4)
    with pytest.raises(ValueError, match="curve"):
        recluster_table(spark, name, ["a"], "hilbert")


def test_file_position_is_the_same_on_every_attempt(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    once, again = (df.select("id", file_position().alias("s")) for _ in range(2))
    assert once.exceptAll(again).isEmpty()
    assert once.select("s").distinct().count() == 1000
    assert order_by_range(df, ["id"], file_position()).count() == 1000


# --- jobs ------------------------------------------------------------------


def _trip_file(tmp_path, *rows):
    lines = [",".join(trips.RAW.names)]
    lines += [",".join(row[c] or "" for c in trips.RAW.names) for row in rows]
    return TextSource("trips", _csv(tmp_path / "in", "\n".join(lines) + "\n"))


def test_stages_one_by_one(spark, layers, tmp_path):
    files = _trip_file(tmp_path, VALID, NEGATIVE_FARE, trip(pulocation_id=""))
    report = jobs.run(spark, layers, [files], [Stage.BRONZE, *Stage])
    assert report.last(Stage.SILVER).rows == (6, 2)
    assert [(o.stage.value, o.done) for o in report.outcomes] == [
        ("bronze", True), ("bronze", True), ("silver", True), ("gold", True)
    ]
    for table, schema in ((layers.bronze, BRONZE), (layers.silver, SILVER), (layers.gold, GOLD)):
        assert [(f.name, f.dataType) for f in spark.table(table).schema] == [
            (f.name, f.dataType) for f in schema
        ]
    source = spark.table(layers.silver).select("_source_file").distinct().collect()
    assert [r[0].endswith("/in/a.csv") for r in source] == [True]
    gold = {tuple(r) for r in spark.table(layers.gold).collect()}
    assert gold == {(zone, 2025, 3, 1, 26.0, 16.0, 6.0, 4.0) for zone in (77, None)}


def test_a_failed_stage_stops_the_run_and_is_reported(spark, layers, tmp_path):
    files = _trip_file(tmp_path, trip(fare_amount="free"))
    report = jobs.Report()
    with pytest.raises(Exception, match="fare_amount"):
        jobs.run(spark, layers, [files], options=jobs.Options(on_error="fail"), report=report)
    assert [(o.stage, o.done) for o in report.outcomes] == [
        (Stage.BRONZE, True), (Stage.SILVER, False)
    ]
    assert report.last(Stage.SILVER).error is not None and report.last(Stage.GOLD) is None
    assert not spark.catalog.tableExists(layers.gold)
    with pytest.raises(FileNotFoundError, match="absent"):
        jobs.run(spark, layers, [TextSource("absent", f"{tmp_path}/absent.csv")])


def test_silver_after_a_delivery_with_one_more_column(spark, layers, tmp_path):
    first = arrived(spark, VALID)
    for batch in (first, first.withColumn("feed", F.lit("b"))):
        append_partitioned(batch, layers.bronze, trips.PARTITIONS, layers.location("bronze"))
    assert jobs.refine(spark, layers) == (2, 1)
    assert spark.table(layers.silver).columns == SILVER.names
    jobs.refine(spark, layers, jobs.Options(extra="carry"))
    assert spark.table(layers.silver).columns == [*SILVER.names, "feed"]
    with pytest.raises(TypeError, match="feed"):
        jobs.refine(spark, layers, jobs.Options(extra="refuse"))


def test_a_snapshot_does_not_see_later_files(spark, name, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "v string, p int")
    append_partitioned(rows, name, ["p"], str(tmp_path / name))
    now = read_snapshot(spark, name)
    append_partitioned(rows, name, ["p"], str(tmp_path / name))
    assert (now.count(), spark.table(name).count()) == (1, 2)


def _as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_a_snapshot_has_the_partitions_of_the_catalog(spark, name, tmp_path, kind):
    """Partitions dropped, added with folders of their own and of misleading names; odd characters."""
    rows = spark.createDataFrame(
        [(1, "a b"), (2, "c/d"), (3, "e%20f"), (4, "[g]*"), (5, None), (6, "gone"), (7, "h=i")], "id int, p string"
    )
    rows.write.format(kind).option("path", str(tmp_path / "a b")).partitionBy("p").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (p = 'gone')")
    spark.range(8, 9).select(F.col("id").cast("int")).write.format(kind).save(str(tmp_path / "p=a b"))
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (p = 'far') LOCATION '{tmp_path}/p=a b'")
    expected = _as_set(spark.table(name))
    assert (8, "far") in expected and (6, "gone") not in expected and len(expected) == 7
    now, plain = read_snapshot(spark, name), read_snapshot(spark, name, partitions=False)
    assert now.schema == spark.table(name).schema and plain.columns == ["id"]
    assert _as_set(now) == expected and _as_set(plain) == {(i,) for i, _ in expected}
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (p = 'far')")
    spark.sql(f"INSERT INTO {name} VALUES (9, 'late')")
    assert _as_set(now) == expected


def test_snapshots_of_what_has_no_files(spark, name, tmp_path):
    spark.range(5).createOrReplaceTempView(f"{name}_temp")
    spark.range(3).write.format("csv").option("path", str(tmp_path / "csv")).saveAsTable(f"{name}_csv")
    spark.sql(f"CREATE VIEW {name}_view AS SELECT id FROM {name}_csv WHERE id > 0")
    for suffix, count in (("temp", 5), ("view", 2), ("csv", 3)):
        now = read_snapshot(spark, f"{name}_{suffix}")
        if suffix == "csv":
            spark.sql(f"INSERT INTO {name}_csv VALUES (4)")
        assert now.count() == count and now.columns == ["id"]
    spark.sql(f"CREATE TABLE {name} (id INT, p INT) USING parquet PARTITIONED BY (p)")
    empty = read_snapshot(spark, name)
    assert empty.count() == 0 and empty.columns == ["id", "p"]
    replace_table(spark.range(4), name)
    assert read_snapshot(spark, name).count() == 4


def test_silver_from_other_formats_and_places(spark, layers, tmp_path):
    """Bronze as ORC and as a view gives what parquet gives."""
    rows = arrived(spark, VALID, NEGATIVE_FARE, trip("other"))
    append_partitioned(rows, layers.bronze, trips.PARTITIONS, layers.location("bronze"))
    rows.write.format("orc").option("path", str(tmp_path / "orc")).saveAsTable(f"{layers.bronze}_orc")
    spark.sql(f"CREATE VIEW {layers.bronze}_view AS SELECT * FROM {layers.bronze}_orc")
    found = []
    for suffix in ("", "_orc", "_view"):
        silver = f"{layers.silver}{suffix}"
        assert jobs.refine(spark, jobs.Layers(f"{layers.bronze}{suffix}", silver, "unused")) == (3, 2)
        found.append(_as_set(spark.table(silver)))
    assert found[0] == found[1] == found[2]


def test_the_width_of_a_job_reaches_the_clustering(spark, layers, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "recluster_table", lambda *args, **named: seen.append(named["width"]))
    width = tuning.Width(partitions=3)
    jobs.run(spark, layers, [_trip_file(tmp_path, VALID)], options=jobs.Options(width=width))
    assert seen == [width]


def test_bigint_counts_reach_gold(spark, layers, tmp_path):
    files = _trip_file(tmp_path, VALID)
    jobs.run(spark, layers, [files], options=jobs.Options(count_type="bigint"))
    assert dict(spark.table(layers.gold).dtypes)["total_trips"] == "bigint"


def test_strict_jobs_stop_on_bad_text(spark, layers, tmp_path):
    files = _trip_file(tmp_path, trip(fare_amount="free"))
    strict = jobs.Options(on_error="fail")
    jobs.ingest(spark, layers, [files], strict)
    with pytest.raises(Exception, match="fare_amount: cannot read as double: free"):
        jobs.refine(spark, layers, strict)


def test_shuffle_width_follows_the_input(spark, tmp_path):
    gib = 1024**3
    assert tuning.shuffle_width(None, 200) == 200
    assert tuning.shuffle_width(gib, 200) == 200
    assert tuning.shuffle_width(1000 * gib, 200) == 2000
    assert tuning.shuffle_width(10**6 * gib, 200) == 2 * 10**6
    assert tuning.shuffle_width(10**6 * gib, 200, most=50_000) == 50_000
    spark.range(10).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    assert 0 < tuning.scanned_bytes(df) < 10_000
    before = spark.conf.get(tuning.SHUFFLE_PARTITIONS)
    with tuning.tuned_for(df, 1e9):
        assert int(spark.conf.get(tuning.SHUFFLE_PARTITIONS)) > int(before)
        assert spark.conf.get(tuning.METHOD_LIMIT) == "8000"
    assert spark.conf.get(tuning.SHUFFLE_PARTITIONS) == before
    assert tuning.Width(input_bytes=100 * gib, target_bytes=gib).of(df, 2.0, 8) == 200
    with tuning.tuned_for(df, width=tuning.Width(partitions=3)):
        assert spark.conf.get(tuning.SHUFFLE_PARTITIONS) == "3"


def test_shared_folder_follows_the_session(spark):
    folders = {shared_folder(spark), shared_folder(spark)}
    assert len(folders) == 2
    assert all(f.startswith(spark.conf.get("spark.checkpoint.dir")) for f in folders)


def test_columns_by_name_follow_each_header(spark, tmp_path):
    folder = tmp_path / "in"
    _csv(folder, "vendor_id,tpep_pickup_datetime\na,1\n", "a.csv")
    _csv(folder, '\n TPEP_pickup_datetime ,"note, long",Vendor_ID\n2,x,b\n3\n', "b.csv")
    _csv(folder, "note,vendor_id,vendor_id\ny,c,other\n", "c [1].csv")
    _csv(folder, "", "empty.csv")
    _csv(folder, "vendor_id\n" + "d\n" * 50_000, "long.csv")
    source = TextSource("in", f"{folder}/*.csv", by_name=True)
    with tuning.settings(spark, spark__sql__files__maxPartitionBytes=20_000):
        rows = source.scan(spark, AB)
        assert rows.schema == AB and rows.where("vendor_id = 'd'").count() == 50_000
    assert _as_set(rows.where("vendor_id is null or vendor_id <> 'd'")) == {("a", "1"), ("b", "2"), (None, "3"), ("c", None)}
    names = rows.select(F.input_file_name().alias("f"), "vendor_id").where("vendor_id = 'b'").first()["f"]
    assert names.endswith("/b.csv")
    blank = TextSource("none", _csv(tmp_path / "none", "", "e.csv"), by_name=True).scan(spark, AB)
    assert blank.schema == AB and blank.count() == 0


def test_full_files_have_the_wanted_size(spark, tmp_path):
    """Twenty partitions of very different sizes, one null, a third of the rows equal in all columns."""
    part = F.when(F.col("id") % 50 < 20, F.floor(F.log2(F.col("id") + 2))).cast("int")
    text = F.when(F.col("id") % 3 > 0, F.sha2(F.col("id").cast("string"), 256)).otherwise("one row")
    df = spark.range(0, 400_000, 1, 7).select(text.alias("x"), part.alias("p"))
    target, name = 400_000, f"t_{uuid.uuid4().hex}"
    for _ in range(2):
        append_partitioned(df, name, ["p"], str(tmp_path / name), written_bytes=target)
    assert spark.table(name).count() == 800_000
    assert spark.table(name).exceptAll(df.unionAll(df)).isEmpty()
    sizes = {}
    for file in (tmp_path / name).rglob("*.parquet"):
        sizes.setdefault(file.parent.name, []).append(file.stat().st_size)
    assert len(sizes) >= 18
    full = [size for own in sizes.values() for size in sorted(own)[2:]]  # each append has a last file
    assert len(full) >= 30 and all(abs(size - target) <= target / 4 for size in full)
    empty = f"t_{uuid.uuid4().hex}"
    append_partitioned(df.limit(0), empty, ["p"], str(tmp_path / empty), written_bytes=target)
    assert spark.table(empty).count() == 0


def test_an_append_rewrites_the_partitions_it_touches(spark, name, tmp_path):
    """One in a hundred rows arrives late; under a tenth of the files are written again."""
    a = (F.xxhash64("id") % 1000).cast("int").alias("a")
    df = spark.range(0, 20_000, 1, 4).select(a, F.col("id"), (F.col("id") % 20).cast("int").alias("p"), F.lit("x y").alias("q"))
    df = df.withColumn("p", F.when(F.col("p") != 19, F.col("p")))
    location = str(tmp_path / name)
    append_partitioned(df, name, ["p", "q"], location)
    first = recluster_partitions(spark, name, ["a", "id"])
    assert first == [(p, "x y") for p in range(19)]
    assert recluster_partitions(spark, name, ["a", "id"]) == []
    before = set(spark.table(name).inputFiles())
    late = df.where("p = 3").limit(200)
    append_partitioned(late, name, ["p", "q"], location)
    assert recluster_partitions(spark, name, ["a", "id"]) == [(3, "x y")]
    after = set(spark.table(name).inputFiles())
    assert len(after - before) < len(after) / 10 and len(after) > 20
    both = df.unionAll(df.where("p = 3").limit(200))
    assert spark.table(name).count() == 20_200 and both.exceptAll(spark.table(name)).isEmpty()
    folder = [f for f in after - before][0]
    assert "/_versions/" in folder
    with pytest.raises(ValueError, match="no partitions"):
        replace_table(spark.range(3), f"{name}_plain", location + "_plain")
        recluster_partitions(spark, f"{name}_plain", ["id"])


def test_a_rebalanced_write_sorts_no_rows(spark, name, tmp_path, monkeypatch):
    seen, save = [], DataFrameWriter.saveAsTable

    def saved(writer, *args):
        seen.append(spark.conf.get(tuning.OPEN_FILES))
        save(writer, *args)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", saved)
    before = spark.conf.get(tuning.OPEN_FILES)
    df = spark.range(1000).selectExpr("id", "id % 100 AS p")
    for rebalance in (True, None):
        append_partitioned(df, name, ["p"], str(tmp_path / "t"), rebalance)
    assert int(seen[0]) > 0 and seen[1] == before == spark.conf.get(tuning.OPEN_FILES)
    # More partitions than are written side by side.
    assert df.unionAll(df).exceptAll(spark.table(name)).isEmpty() and spark.table(name).count() == 2000


def test_ranges_of_files_take_no_sort(spark, name, tmp_path):
    rows = [(p, a, b, None if i % 5 else float("nan")) for i, (p, a, b) in enumerate(
        (p, a, b) for p in (1, 2, None) for a in (None, 3, 3, 7) for b in (None, 1, 2, 2)
    )]
    rows += [(4, None, None, None), (5, 1, 1, 1.0)]
    df = spark.createDataFrame(rows, "p int, a int, b long, c double").repartition(3)
    append_partitioned(df, name, ["p"], str(tmp_path / "t"))
    table = spark.table(name)
    for columns in (["a"], ["a", "b"], ["b", "c", "a"]):
        found = tables._file_ranges(table, ["p"], columns)
        row = F.struct(*columns)
        wanted = table.groupBy("p", "_metadata.file_path").agg(F.min(row), F.max(row))

        def plain(df, at):
            return sorted(repr((r["p"], *map(tuple, r[at:]))) for r in df.collect())

        assert plain(found, 1) == plain(wanted, 2)
        assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_large_append_is_rebalanced_unless_told_otherwise(spark, tmp_path, monkeypatch):
    """Eight tasks with rows of both partitions write a file to each, or one shuffle gathers them."""
    spark.range(0, 8000, 1, 8).selectExpr("id", "id % 2 as p").write.parquet(str(tmp_path / "source"))
    df = spark.read.parquet(*sorted(str(f) for f in (tmp_path / "source").glob("*.parquet"))).repartition(8)
    files = {}
    for most, rebalance in ((None, None), (1, None), (1, False)):
        with monkeypatch.context() as patch:
            if most is not None:
                patch.setattr("siftlayer.sinks.tables._SORTED_BYTES", most)
            name = f"large_{most}_{rebalance}".lower()
            append_partitioned(df, name, ["p"], str(tmp_path / name), rebalance)
        assert spark.table(name).count() == 8000
        files[most, rebalance] = len(list((tmp_path / name).rglob("*.parquet")))
        spark.sql(f"DROP TABLE {name}")
    assert files == {(None, None): 16, (1, None): 2, (1, False): 16}
