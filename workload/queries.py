"""One query per operator or job, over whole tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlayer.functions import day_part, elapsed_minutes, guarded_percentage, is_weekend
from siftlayer.functions.calendar import epoch_seconds
from siftlayer.operators import (
    Field,
    add_lineage,
    add_month_partitions,
    apply_types,
    deduplicate,
    keep_valid,
    mean,
    ratio_of_totals,
    row_count,
    summarise,
    total,
)
from siftlayer.operators.validity import non_negative, not_before, positive
from siftlayer.plans import jobs, trips
from siftlayer.sinks import (
    append_partitioned,
    recluster_partitions,
    recluster_table,
    replace_table,
)
from siftlayer.sources import TextSource, locate, read_table
from siftlayer.tuning import scanned_bytes, shuffle_width
from siftlayer.workspace import shared_folder
from workload import inputs

# Money and distances of the test tables have at most four decimals.
SCALE = 4


def _fresh_layers(spark: SparkSession) -> jobs.Layers:
    suffix = uuid.uuid4().hex
    return jobs.Layers(
        f"bronze_{suffix}", f"silver_{suffix}", f"gold_{suffix}", shared_folder(spark)
    )


def _wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, the type the oracle has."""
    return df.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name, t in df.dtypes if t == "timestamp"}
    )


def _visible(df: DataFrame) -> DataFrame:
    """Without the columns that differ from run to run."""
    return _wall_clock(df.drop("_ingested_at", "_source_file"))


# --- sources ---------------------------------------------------------------


def csv_scan_strings(spark, sf_dir):
    files = inputs.raw_trip_files(spark, sf_dir, shared_folder(spark))
    return TextSource("trips", files).scan(spark, trips.RAW)


def source_fallback(spark, sf_dir):
    folder = shared_folder(spark)
    files = inputs.raw_trip_files(spark, sf_dir, folder)
    sources = [TextSource("resent", f"{folder}/absent/*.csv"), TextSource("trips", files)]
    return locate(spark, sources).scan(spark, trips.RAW)


def csv_scan_by_header(spark, sf_dir):
    """Two deliveries under one folder: the second has its columns in another order, one more, and other case."""
    folder = shared_folder(spark)
    raw = inputs.raw_trips(spark, sf_dir)
    late = F.expr("to_date(tpep_pickup_datetime) >= '2024-01-15'")
    titles = [f.upper() if i % 2 else f for i, f in enumerate(reversed(raw.columns))]
    other = raw.where(late).select(*(F.col(t.lower()).alias(t) for t in titles), F.lit("x").alias("note"))
    for name, delivery in (("first", raw.where(~late)), ("second", other)):
        delivery.write.option("header", True).csv(f"{folder}/deliveries/{name}")
    return TextSource("trips", f"{folder}/deliveries/*/*.csv", by_name=True).scan(spark, trips.RAW)


# --- bronze ----------------------------------------------------------------


def bronze_audit(spark, sf_dir):
    arrived = add_month_partitions(
        add_lineage(inputs.events(spark, sf_dir)), F.col("ts"), "pickup_year", "pickup_month"
    )
    return arrived.select(
        "event_id",
        F.col("_ingested_at").isNotNull().alias("has_ingest_time"),
        F.col("_source_file").contains("events.parquet").alias("has_source_file"),
        "pickup_year",
        "pickup_month",
    )


def _bronze_per_month(spark, sf_dir, rebalance):
    """The source arrives twice; the second time with one more column."""
    layers = _fresh_layers(spark)
    first = trips.to_bronze(inputs.raw_trips(spark, sf_dir))
    second = first.withColumn("feed", F.lit("resent"))
    for batch in (first, second):
        append_partitioned(
            batch, layers.bronze, trips.PARTITIONS, layers.location("bronze"), rebalance
        )
    return summarise(
        read_table(spark, layers.bronze),
        {c: F.col(c) for c in trips.PARTITIONS},
        row_count("rows", "bigint"),
        F.count("feed").alias("resent_rows"),
        F.countDistinct("tpep_pickup_datetime").alias("pickups"),
    )


def bronze_partition_append(spark, sf_dir):
    return _bronze_per_month(spark, sf_dir, None)


def bronze_partition_append_rebalanced(spark, sf_dir):
    return _bronze_per_month(spark, sf_dir, True)


def _per_month(spark, table):
    return summarise(
        read_table(spark, table),
        {c: F.col(c) for c in trips.PARTITIONS},
        row_count("rows", "bigint"),
        F.countDistinct("tpep_pickup_datetime").alias("pickups"),
    )


def _append(batch, layers, **options):
    location = layers.location("bronze")
    append_partitioned(batch, layers.bronze, trips.PARTITIONS, location, **options)


def bronze_months(spark, sf_dir):
    """Line items as trips of some eighty months, one day in 97 unreadable."""
    layers = _fresh_layers(spark)
    arrived = trips.to_bronze(inputs.line_trips(spark, sf_dir))
    _append(arrived, layers, rebalance=True, file_bytes=256 * 2**20)
    return _per_month(spark, layers.bronze)


def bronze_sized_files(spark, sf_dir):
    """Line items by year in files of 64 KiB: whether all but the last of each year are near that."""
    layers = _fresh_layers(spark)
    arrived = trips.to_bronze(inputs.line_trips(spark, sf_dir)).drop("pickup_month")
    target = 64 * 2**10
    append_partitioned(
        arrived, layers.bronze, ["pickup_year"], layers.location("bronze"), written_bytes=target
    )
    file = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("bytes"))
    files = read_table(spark, layers.bronze).groupBy("pickup_year", file.alias("file")).count()
    full = F.sort_array(F.collect_list("file.bytes"))
    # The last file of a year is the smallest or, where it is full as well, any of them.
    near = F.forall(F.slice(full, 2, F.greatest(F.size(full) - 1, F.lit(0))), lambda b: F.abs(b - target) <= target / 4)
    return files.groupBy("pickup_year").agg(F.sum("count").alias("rows"), near.alias("near"))


def bronze_overwrite(spark, sf_dir):
    """Events arrive, then line items in their place."""
    layers = _fresh_layers(spark)
    _append(trips.to_bronze(inputs.raw_trips(spark, sf_dir)), layers)
    _append(trips.to_bronze(inputs.line_trips(spark, sf_dir)), layers, mode="overwrite")
    return _per_month(spark, layers.bronze)


def append_unregistered(spark, sf_dir):
    """The folder holds the line items of a table that the catalog has forgotten."""
    layers = _fresh_layers(spark)
    _append(trips.to_bronze(inputs.line_trips(spark, sf_dir)), layers)
    spark.sql(f"DROP TABLE {layers.bronze}")
    _append(trips.to_bronze(inputs.raw_trips(spark, sf_dir)), layers)
    return _per_month(spark, layers.bronze)


# --- typing and projection -------------------------------------------------


def typing_null_policy(spark, sf_dir):
    typed = trips.typed(trips.to_bronze(inputs.raw_trips(spark, sf_dir)))
    return _visible(typed)


def typing_mixed_text(spark, sf_dir):
    """One text column in many shapes, read as each of the types."""
    text = F.expr(
        """case event_id % 8
             when 0 then cast(event_id as string)
             when 1 then concat(' ', cast(event_id as string), '.0 ')
             when 2 then concat('-', cast(event_id as string), '.75')
             when 3 then ''
             when 4 then props
             when 5 then cast(event_id * 1000000000 as string)
             when 6 then concat('.', cast(event_id as string))
             else cast(ts as string) end"""
    )
    shaped = inputs.events(spark, sf_dir).select(
        "event_id", *(text.alias(c) for c in ("as_int", "as_bigint", "as_double", "text"))
    )
    fields = [
        Field("as_int", "int"),
        Field("as_bigint", "bigint"),
        Field("as_double", "double"),
        Field("as_moment", "timestamp", "text"),
    ]
    # A bare number is also a year to the timestamp parser, up to six digits of
    # it; as text such moments can be shown whatever the year.
    typed = apply_types(shaped, fields)
    return typed.withColumn("as_moment", F.col("as_moment").cast("string"))


def rename_drop_project(spark, sf_dir):
    fields = [
        Field("started", "timestamp", "tpep_pickup_datetime"),
        Field("ended", "timestamp", "tpep_dropoff_datetime"),
        Field("payment_type", "int"),
    ]
    raw = inputs.raw_trips(spark, sf_dir).select(
        "vendor_id", "tpep_pickup_datetime", "payment_type", "tpep_dropoff_datetime"
    )
    return _wall_clock(
        apply_types(raw, fields).withColumn("currency", F.lit("USD")).drop("vendor_id")
    )


# --- validity --------------------------------------------------------------


def _kept(spark, sf_dir, *rules):
    native = inputs.native_trips(spark, sf_dir)
    return _wall_clock(keep_valid(native, rules) if rules else trips.valid(native))


def valid_rows(spark, sf_dir):
    return _kept(spark, sf_dir)


def valid_fare(spark, sf_dir):
    return _kept(spark, sf_dir, non_negative("fare_amount"))


def valid_passengers(spark, sf_dir):
    return _kept(spark, sf_dir, positive("passenger_count"))


def valid_order(spark, sf_dir):
    return _kept(spark, sf_dir, not_before("dropoff_datetime", "pickup_datetime"))


def valid_lines(spark, sf_dir):
    """Rules on stored columns, which reach the parquet scan."""
    return keep_valid(
        inputs.lineitem(spark, sf_dir).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount"
        ),
        [non_negative("l_quantity"), positive("l_discount")],
    )


# --- derivation ------------------------------------------------------------


def _over_trips(spark, sf_dir, **columns):
    native = inputs.native_trips(spark, sf_dir)
    return native.select("event_id", *(c.alias(name) for name, c in columns.items()))


def epoch_of_pickup(spark, sf_dir):
    return _over_trips(spark, sf_dir, pickup_seconds=epoch_seconds(F.col("pickup_datetime")))


def trip_duration(spark, sf_dir):
    minutes = elapsed_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return _over_trips(spark, sf_dir, trip_duration_minutes=minutes)


def calendar_parts(spark, sf_dir):
    pickup = F.col("pickup_datetime")
    return _over_trips(
        spark,
        sf_dir,
        pickup_year=F.year(pickup),
        pickup_month=F.month(pickup),
        pickup_hour=F.hour(pickup),
        pickup_weekday=F.dayofweek(pickup),
    )


def time_of_day(spark, sf_dir):
    return _over_trips(spark, sf_dir, time_of_day=day_part(F.col("pickup_datetime")))


def weekend_flag(spark, sf_dir):
    return _over_trips(spark, sf_dir, is_weekend=is_weekend(F.col("pickup_datetime")))


def tip_percentage(spark, sf_dir):
    share = guarded_percentage(F.col("tip_amount"), F.col("fare_amount"))
    return _over_trips(spark, sf_dir, tip_percentage=share)


def derived_all(spark, sf_dir):
    return _wall_clock(trips.derived(inputs.native_trips(spark, sf_dir)))


# --- dedup and counts ------------------------------------------------------


def dedup_any(spark, sf_dir):
    once = inputs.native_trips(spark, sf_dir)
    unique = trips.unique(once.unionByName(once), keep="any")
    return _wall_clock(unique.select(*trips.TRIP_KEY))


def dedup_first_by(spark, sf_dir):
    return deduplicate(
        inputs.lineitem(spark, sf_dir),
        ["l_orderkey", "l_linenumber", "no_such_column"],
        order_by=["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"],
    )


def row_counts(spark, sf_dir):
    arrived = trips.to_bronze(inputs.raw_trips(spark, sf_dir))
    return trips.counts(arrived.unionByName(arrived))


# --- metrics ---------------------------------------------------------------


def _by_zone_and_month(spark, sf_dir, *measures):
    return summarise(
        inputs.silver_lines(spark, sf_dir),
        {
            "zone_id": F.col("pulocation_id"),
            "year": F.col("pickup_year"),
            "month": F.col("pickup_month"),
        },
        *measures,
    )


def gold_count(spark, sf_dir):
    return _by_zone_and_month(spark, sf_dir, row_count("total_trips"))


def gold_sum(spark, sf_dir):
    return _by_zone_and_month(
        spark, sf_dir, total(F.col("total_amount"), "total_revenue", SCALE)
    )


def gold_avg(spark, sf_dir):
    return _by_zone_and_month(
        spark,
        sf_dir,
        mean(F.col("fare_amount"), "avg_fare", SCALE),
        mean(F.col("tip_amount"), "avg_tip", SCALE),
    )


def gold_ratio(spark, sf_dir):
    return _by_zone_and_month(
        spark,
        sf_dir,
        ratio_of_totals(F.col("total_amount"), F.col("trip_distance"), "revenue_per_mile", SCALE),
    )


def gold_metrics(spark, sf_dir):
    return trips.to_gold(inputs.silver_lines(spark, sf_dir), SCALE)


def gold_bigint(spark, sf_dir):
    return trips.to_gold(inputs.silver_lines(spark, sf_dir), SCALE, "bigint")


def gold_metrics_default(spark, sf_dir):
    """Sums of doubles as they are, over rows dealt anew; every digit is shown."""
    rows = inputs.silver_lines(spark, sf_dir)
    # Nearly every row is a group of its own to the task it goes to, so tasks must not grow with the table.
    width = shuffle_width(scanned_bytes(rows), 13, 8 * 2**20)
    return trips.to_gold(rows.repartition(width, "trip_distance", "total_amount"))


def gold_metrics_of_trips(spark, sf_dir):
    """Few broad groups: the zones of the events, all in one month."""
    bronze = trips.to_bronze(inputs.raw_trips(spark, sf_dir))
    return trips.to_gold(trips.to_silver(bronze), SCALE)


# --- sinks and layout ------------------------------------------------------


def silver_replace(spark, sf_dir):
    """The table first holds other columns, then silver."""
    layers = _fresh_layers(spark)
    replace_table(
        inputs.native_trips(spark, sf_dir), layers.silver, layers.location("silver")
    )
    silver = trips.to_silver(trips.to_bronze(inputs.raw_trips(spark, sf_dir)))
    replace_table(silver, layers.silver, layers.location("silver"))
    return _visible(read_table(spark, layers.silver))


def gold_replace(spark, sf_dir):
    """The table holds one metric, then all, then all again under the same schema."""
    layers = _fresh_layers(spark)
    for contents in (gold_count, gold_metrics, gold_metrics):
        replace_table(contents(spark, sf_dir), layers.gold, layers.location("gold"))
    return read_table(spark, layers.gold)


def replace_managed(spark, sf_dir):
    """A managed table holds the counts, then all metrics."""
    name = _fresh_layers(spark).gold
    gold_count(spark, sf_dir).write.format("parquet").saveAsTable(name)
    replace_table(gold_metrics(spark, sf_dir), name)
    return read_table(spark, name)


def replace_partitioned(spark, sf_dir):
    """A table partitioned by year holds every group twice, then once."""
    layers = _fresh_layers(spark)
    gold = gold_metrics(spark, sf_dir)
    for contents in (gold.unionByName(gold), gold):
        replace_table(contents, layers.gold, layers.location("gold"), ["year"])
    return read_table(spark, layers.gold)


def _reclustered(spark, sf_dir, curve):
    layers = _fresh_layers(spark)
    location = layers.location("gold")
    replace_table(gold_metrics(spark, sf_dir), layers.gold, location)
    recluster_table(spark, layers.gold, trips.GOLD_ORDER, curve, location=location)
    return read_table(spark, layers.gold)


def layout_zorder(spark, sf_dir):
    return _reclustered(spark, sf_dir, "morton")


def layout_range(spark, sf_dir):
    return _reclustered(spark, sf_dir, "linear")


def _files_skipped(spark, sf_dir, curve, columns):
    """For a filter on each column its rows, and whether at most half of the files can hold any."""
    layers = _fresh_layers(spark)
    replace_table(inputs.lineitem(spark, sf_dir), layers.gold, layers.location("gold"))
    recluster_table(
        spark, layers.gold, columns, curve, location=layers.location("gold"), partitions=16
    )
    rows = read_table(spark, layers.gold)
    parts = []
    for column in columns:
        bound = rows.agg(F.max(column)).first()[0] / 8
        files = rows.groupBy("_metadata.file_path").agg(
            F.min(column).alias("least"), F.count_if(F.col(column) <= bound).alias("matched")
        )
        skips = 2 * F.count_if(F.col("least") <= bound) <= F.count(F.lit(1))
        parts.append(
            files.agg(
                F.lit(column).alias("filtered"),
                skips.alias("skips"),
                F.sum("matched").alias("matched"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def layout_zorder_files(spark, sf_dir):
    return _files_skipped(spark, sf_dir, "morton", ["l_partkey", "l_suppkey"])


def layout_range_files(spark, sf_dir):
    return _files_skipped(spark, sf_dir, "linear", ["l_partkey"])


def layout_overlaps(spark, sf_dir):
    """Line items by month, clustered; then some of one month arrive late, and only that month is rewritten."""
    name, location = _fresh_layers(spark).gold, f"{shared_folder(spark)}/lines"
    lines = inputs.lineitem(spark, sf_dir).withColumns(
        {"y": F.year("l_shipdate"), "m": F.month("l_shipdate")}
    )
    late = F.expr("y = 2000 AND m = 5 AND l_orderkey % 2 = 0")
    # Twice, so that every month begins with files that overlap.
    for part in (lines.where(~late & F.expr("l_partkey % 3 = 0")), lines.where(~late & F.expr("l_partkey % 3 <> 0"))):
        append_partitioned(part, name, ["y", "m"], location)
    recluster_partitions(spark, name, ["l_partkey", "l_suppkey"])
    before = [path.rpartition("/")[2] for path in read_table(spark, name).inputFiles()]
    append_partitioned(lines.where(late), name, ["y", "m"], location)
    recluster_partitions(spark, name, ["l_partkey", "l_suppkey"])
    after = read_table(spark, name)
    kept = after.metadataColumn("_metadata")["file_name"].isin(before)
    return after.groupBy("y", "m").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("l_partkey").alias("parts"),
        (~F.bool_or(kept)).alias("rewritten"),
    )


# --- jobs ------------------------------------------------------------------


BRONZE, SILVER, GOLD = jobs.Stage


def _after(spark, sf_dir, *stages, options=jobs.Options(scale=SCALE)):
    """Layers after the stages; a repeated first stage ingests all files again."""
    layers = _fresh_layers(spark)
    files = TextSource("trips", inputs.raw_trip_files(spark, sf_dir, layers.folder))
    report = jobs.run(spark, layers, [files], stages, options)
    return layers, report


def bronze_job(spark, sf_dir):
    layers, _ = _after(spark, sf_dir, BRONZE, BRONZE)
    return read_table(spark, layers.bronze).drop("_ingested_at", "_source_file")


def silver_job(spark, sf_dir):
    layers, _ = _after(spark, sf_dir, BRONZE, BRONZE, SILVER)
    return _visible(read_table(spark, layers.silver))


def silver_after_growth(spark, sf_dir):
    """The second delivery has one more column; silver is made of both."""
    layers = _fresh_layers(spark)
    first = trips.to_bronze(inputs.raw_trips(spark, sf_dir))
    for batch in (first, first.withColumn("feed", F.lit("resent"))):
        _append(batch, layers)
    jobs.refine(spark, layers)
    return _visible(read_table(spark, layers.silver))


def silver_after_partition_drop(spark, sf_dir):
    """Bronze loses one month and gets another from a folder of its own; silver follows the catalog."""
    layers = _fresh_layers(spark)
    arrived = trips.to_bronze(inputs.line_trips(spark, sf_dir))
    elsewhere = "pickup_year = 1996 AND pickup_month = 7"
    _append(arrived.where(f"NOT coalesce({elsewhere}, false)"), layers)
    spark.sql(f"ALTER TABLE {layers.bronze} DROP PARTITION (pickup_year = 1995, pickup_month = 3)")
    folder = f"{layers.folder}/one_month"
    arrived.where(elsewhere).drop(*trips.PARTITIONS).write.parquet(folder)
    spark.sql(
        f"ALTER TABLE {layers.bronze} ADD PARTITION (pickup_year = 1996, pickup_month = 7) LOCATION '{folder}'"
    )
    rows_in, _ = jobs.refine(spark, layers)
    silver = read_table(spark, layers.silver)
    months = {c: F.col(c) for c in trips.PARTITIONS}
    return summarise(silver, months, row_count("trips", "bigint")).withColumn(
        "rows_in", F.lit(rows_in).cast("bigint")
    )


def silver_job_counts(spark, sf_dir):
    """What the silver job reports, next to its result."""
    layers, report = _after(spark, sf_dir, BRONZE, BRONZE, SILVER)
    rows_in, rows_out = report.last(SILVER).rows
    return read_table(spark, layers.silver).agg(
        F.count(F.lit(1)).alias("rows_in_table"),
        F.lit(rows_in).cast("bigint").alias("rows_in"),
        F.lit(rows_out).cast("bigint").alias("rows_out"),
    )


def gold_job(spark, sf_dir):
    plain = jobs.Options(scale=SCALE, optimize=False)
    layers, _ = _after(spark, sf_dir, BRONZE, BRONZE, SILVER, GOLD, options=plain)
    return read_table(spark, layers.gold)


def full_pipeline(spark, sf_dir):
    rebalanced = jobs.Options(scale=SCALE, rebalance=True)
    layers, _ = _after(spark, sf_dir, BRONZE, SILVER, GOLD, options=rebalanced)
    return read_table(spark, layers.gold)


QUERIES = {
    query.__name__: query
    for query in (
        csv_scan_strings,
        source_fallback,
        csv_scan_by_header,
        bronze_audit,
        bronze_partition_append,
        bronze_partition_append_rebalanced,
        bronze_months,
        bronze_overwrite,
        bronze_sized_files,
        append_unregistered,
        typing_null_policy,
        typing_mixed_text,
        rename_drop_project,
        valid_rows,
        valid_fare,
        valid_passengers,
        valid_order,
        valid_lines,
        epoch_of_pickup,
        trip_duration,
        calendar_parts,
        time_of_day,
        weekend_flag,
        tip_percentage,
        derived_all,
        dedup_any,
        dedup_first_by,
        row_counts,
        gold_count,
        gold_sum,
        gold_avg,
        gold_ratio,
        gold_metrics,
        gold_bigint,
        gold_metrics_default,
        gold_metrics_of_trips,
        silver_replace,
        gold_replace,
        replace_managed,
        replace_partitioned,
        layout_zorder,
        layout_range,
        layout_zorder_files,
        layout_range_files,
        layout_overlaps,
        bronze_job,
        silver_job,
        silver_after_growth,
        silver_after_partition_drop,
        silver_job_counts,
        gold_job,
        full_pipeline,
    )
}
