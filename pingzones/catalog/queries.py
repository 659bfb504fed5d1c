"""Registered queries: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingzones.catalog import derived
from pingzones.catalog.derived import pings, sample_index, supplier_index
from pingzones.functions import bins, parsing
from pingzones.operators import numbering, paging
from pingzones.operators.pull import pull
from pingzones.operators.shared_folder import new_folder
from pingzones.operators.zone_index import build_zone_index
from pingzones.operators.zone_join import with_zone
from pingzones.plans import cycle, transform
from pingzones.schema import OUTSIDE, PING_COLUMNS, PING_SCHEMA
from pingzones.sinks.logged import LoggedTarget
from pingzones.sinks.targets import PathTarget, latest_time_of_files
from pingzones.sources import pings as source
from pingzones.sources.zones import empty_zones, read_zones, zones_from_features
from pingzones.streaming.cycle import start_stream

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the incremental queries: a mark and the edges of three pages.
MARK = datetime(2024, 1, 15)
PAGE_EDGES = (datetime(2024, 1, 11), datetime(2024, 1, 21))
PAGE_KEY = (datetime(2024, 1, 5), 0)
LOOKBACK = timedelta(days=10)
# Pings of this network type reach the source only after the first cycle.
SLOW_NETWORK = "3G"


# --- sources and paging ----------------------------------------------------


def full_scan(spark, sf_dir):
    folder = new_folder(spark, "full-scan")
    pings(spark, sf_dir).write.parquet(folder)
    return source.read_pings(spark, "parquet", path=folder)


def incremental_scan(spark, sf_dir):
    return paging.newer_than(pings(spark, sf_dir), MARK)


def page_scan(spark, sf_dir):
    folder = new_folder(spark, "pages")
    source.write_pages(pings(spark, sf_dir), folder)
    return source.read_pings(spark, "pages", path=folder, multi_line=False)


def csv_scan(spark, sf_dir):
    folder = new_folder(spark, "csv")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    text_time = parsing.format_timestamp(F.col("timestamp"), "T")
    reversed_order = (
        pings(spark, sf_dir).withColumn("timestamp", text_time).select(*reversed(PING_COLUMNS))
    )
    reversed_order.write.options(header=True, **keep).csv(folder)
    return source.read_pings(spark, "csv", path=folder)


def offset_page(spark, sf_dir):
    return paging.offset_page(pings(spark, sf_dir), paging.PAGE_SIZE)


def offset_pages_of_equal_keys(spark, sf_dir):
    """Four pages over whole hours and repeated ids: every row once, with all its columns."""
    hourly = pings(spark, sf_dir).withColumns(
        {"timestamp": F.date_trunc("hour", "timestamp").cast("timestamp_ntz"), "id": F.col("id") % 10}
    )
    size = -(-hourly.count() // 4)
    directory = paging.page_directory(hourly, size)
    return source.union_pages([paging.directory_page(hourly, directory, at, size) for at in range(4)])


def keyset_page(spark, sf_dir):
    return paging.keyset_page(pings(spark, sf_dir), PAGE_KEY)


def keyset_full_pull(spark, sf_dir):
    # Whole hours, so that many rows share the time of a page edge.
    hourly = pings(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    return paging.newer_than(hourly, MARK)


def keyset_pull_resumed(spark, sf_dir):
    """Whole hours pulled in pages, by one run over the early rows and one that goes on behind them."""
    hourly = pings(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    target = LoggedTarget(spark, new_folder(spark, "pulled"), PING_SCHEMA, "timestamp")
    log = new_folder(spark, "pull-log")
    for rows in (hourly.filter(F.col("timestamp") <= parsing.ntz(MARK)), hourly):
        # A third of the rows a page, whatever the table's size.
        pull(rows, log, lambda page, n: target.append_once(page, log, n), max(1, -(-rows.count() // 3)))
    return target.read()


def union_pages(spark, sf_dir):
    time = F.col("timestamp")
    low, high = (parsing.ntz(t) for t in PAGE_EDGES)
    everything = pings(spark, sf_dir)
    return source.union_pages(
        [
            everything.filter(time < low),
            everything.filter((time >= low) & (time < high)),
            everything.filter(time >= high),
        ]
    )


def drop_missing_id(spark, sf_dir):
    # Pings without a coordinate stand for rows whose id was lost as well.
    known = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return source.drop_missing_id(pings(spark, sf_dir).withColumn("id", F.when(known, F.col("id"))))


# --- zones -----------------------------------------------------------------


def zone_table(spark, sf_dir):
    folder = new_folder(spark, "geojson")
    derived.write_supplier_geojson(spark, sf_dir, folder)
    return read_zones(spark, folder).select(
        "ord", "name", F.size("edges").alias("n_edges"), "x0", "x1", "y0", "y1"
    )


def zone_of_ping(spark, sf_dir):
    return with_zone(pings(spark, sf_dir), sample_index(spark)).select("id", "zona")


def zone_boundary(spark, sf_dir):
    def snapped(c):
        return F.floor(F.col(c) * 20 + 0.5).cast("double") / F.lit(20.0)

    on_grid = pings(spark, sf_dir).withColumns(
        {"latitude": snapped("latitude"), "longitude": snapped("longitude")}
    )
    return with_zone(on_grid, sample_index(spark)).select("id", "latitude", "longitude", "zona")


def zone_slanted_edges(spark, sf_dir):
    """Points on slanted edges, which are outside, and a billionth of a degree beside them."""
    points = derived.table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {c}" for c, e in derived.SLANTED_POINTS.items()])
    return with_zone(points, sample_index(spark)).select("id", "longitude", "latitude", "zona")


def zone_empty(spark, sf_dir):
    index = build_zone_index(empty_zones(spark))
    return with_zone(pings(spark, sf_dir), index).select("id", "zona")


def zone_of_ping_many_zones(spark, sf_dir):
    return with_zone(pings(spark, sf_dir), supplier_index(spark, sf_dir)).select("id", "zona")


def zone_of_ping_shuffled(spark, sf_dir):
    """The path for an index too large to broadcast."""
    narrow = pings(spark, sf_dir).select("id", "latitude", "longitude")
    index = supplier_index(spark, sf_dir)
    return with_zone(narrow, index, broadcast_limit=0).select("id", "zona")


def zone_of_ping_crowded(spark, sf_dir):
    """Thousands of small zones in one place, large ones behind them and a narrow strip: built, then joined."""
    index = build_zone_index(zones_from_features(derived.crowded_features(spark, sf_dir)))
    return with_zone(pings(spark, sf_dir), index).select("id", "zona")


# --- columns ---------------------------------------------------------------


def _bin(column: str, function, out: str) -> Query:
    return lambda spark, sf_dir: pings(spark, sf_dir).select(
        "id", column, function(column).alias(out)
    )


def coordinate_parse(spark, sf_dir):
    """Coordinates as text, some of them not numbers, labelled by the zone step."""
    e = derived.table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))
    )
    located = e.select("event_id", text.alias("latitude"), F.lit(0.0).alias("longitude"))
    status = F.when(F.col("zona") == OUTSIDE, "ok").otherwise(F.col("zona"))
    return with_zone(located, build_zone_index(empty_zones(spark))).select(
        "event_id", parsing.parse_coordinate(F.col("latitude")).alias("coordinate"), status.alias("status")
    )


def parse_timestamps(spark, sf_dir):
    """ISO texts with and without an offset, in both forms, and some that are no times."""
    ts, kind, n = F.col("ts"), F.col("event_type"), F.col("event_id") % 4
    text = parsing.format_timestamp(ts, "T")
    basic = F.date_format(ts, "yyyyMMdd'T'HHmmss.SSSSSS")
    by_type = (
        F.when(kind == "click", F.when(n == 0, basic).otherwise(text))
        .when(kind == "view", F.concat(F.when(n == 0, basic).otherwise(text), F.lit("Z")))
        .when(
            kind == "error",
            F.when(n == 0, F.concat(F.lit("at "), text))
            .when(n == 1, F.concat(text, F.lit(" America/New_York")))
            .when(n == 2, F.concat(text, F.lit(" UTC")))
            .otherwise(F.substring(text, 11, 16)),
        )
        .otherwise(F.concat(text, F.when(n == 0, "-0400").otherwise("-04:00")))
    )
    return derived.table(spark, sf_dir, "events").select(
        "event_id", parsing.parse_iso_timestamp(by_type).alias("fecha_hora")
    )


def format_timestamps(spark, sf_dir):
    ts = F.col("timestamp")
    return pings(spark, sf_dir).select(
        "id",
        parsing.format_timestamp(ts).alias("blank_text"),
        parsing.format_timestamp(ts, "T").alias("iso_text"),
    )


def output_shape(spark, sf_dir):
    zoned = with_zone(pings(spark, sf_dir), build_zone_index(empty_zones(spark)))
    return transform.output_shape(zoned.withColumns(transform.category_columns()))


def fill_labels(spark, sf_dir):
    """Zones by a join that leaves unmatched pings without a label."""
    labels = pings(spark, sf_dir).select("id", "device_id", "sim_operator")
    customers = derived.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    zone = customers.select(
        F.concat(F.lit("ID_"), F.col("c_custkey").cast("string")).alias("device_id"),
        F.col("c_mktsegment").alias("zona"),
    )
    joined = labels.join(zone, "device_id", "left")
    return transform.fill_labels(
        joined.select("id", "zona", F.nullif("sim_operator", F.lit("")).alias("compania"))
    )


def enriched_pings(spark, sf_dir):
    return transform.label_pings(pings(spark, sf_dir), sample_index(spark))


def category_rollup(spark, sf_dir):
    return cycle.category_rollup(enriched_pings(spark, sf_dir))


# --- targets and cycles ----------------------------------------------------


def target_high_water_mark(spark, sf_dir):
    target = PathTarget(spark, new_folder(spark, "mark"))
    shaped = output_shape(spark, sf_dir)
    early = F.col("fecha_hora") < parsing.ntz(MARK)
    # The later rows are written first: the newest files need not hold the maximum.
    target.append(shaped.filter(~early))
    target.append(shaped.filter(early))
    return latest_time_of_files(target.read())


def next_id(spark, sf_dir):
    highest = numbering.max_id(pings(spark, sf_dir))
    return highest.select((F.col("max_id").cast("bigint") + 1).alias("next_id"))


def append_with_ids(spark, sf_dir):
    """Every event again as a new ping one minute later, with ids that go on."""
    existing = pings(spark, sf_dir)
    rows = numbering.with_row_index(existing, "i", ["timestamp", "id"])
    i = F.col("i")
    # A copy of the ping, read by another device of the same kind.
    new = rows.withColumns(
        {
            "device_name": F.concat_ws("-", F.lit("again"), F.lpad(i.cast("string"), 12, "0")),
            "timestamp": F.col("timestamp") + F.expr("INTERVAL 1 MINUTE"),
        }
    ).drop("i", "id", "device_id")
    numbered = numbering.with_next_ids(new, existing, order_by=["timestamp", "device_name"])
    with_device = numbered.withColumn("device_id", F.concat(F.lit("again-"), F.col("id").cast("string")))
    return existing.unionByName(with_device)


def append_roundtrip(spark, sf_dir):
    target = PathTarget(spark, new_folder(spark, "append"))
    labelled = enriched_pings(spark, sf_dir)
    early = F.col("fecha_hora") < parsing.ntz(MARK)
    target.append(labelled.filter(early))
    target.append(labelled.filter(~early))
    return target.read()


def seed_roundtrip(spark, sf_dir):
    """A second load replaces the first."""
    target = PathTarget(spark, new_folder(spark, "seed"), PING_SCHEMA)
    everything = pings(spark, sf_dir)
    target.replace(everything)
    target.replace(everything.withColumn("device_name", F.upper("network_type")))
    return target.read()


def logged_append(spark, sf_dir):
    """Two appends and one that fails after its first rows, of which nothing is seen."""
    target = LoggedTarget(spark, new_folder(spark, "logged"))
    labelled = enriched_pings(spark, sf_dir)
    early = F.col("fecha_hora") < parsing.ntz(MARK)
    target.append(labelled.filter(early))
    # Files of an append that died before its entry: nobody names them.
    target.staged(labelled.filter(~early))
    target.append(labelled.filter(~early))
    return target.read()


def logged_replace(spark, sf_dir):
    """Rows replaced by others that are made from them."""
    target = LoggedTarget(spark, new_folder(spark, "replaced"), PING_SCHEMA, "timestamp")
    target.append(pings(spark, sf_dir))
    target.replace(target.read().withColumn("device_name", F.upper("network_type")))
    return target.read()


def logged_mark(spark, sf_dir):
    """High-water mark and rows of each append, from the log."""
    target = LoggedTarget(spark, new_folder(spark, "logged-mark"))
    shaped = output_shape(spark, sf_dir)
    early = F.col("fecha_hora") < parsing.ntz(MARK)
    target.append(shaped.filter(~early))
    target.append(shaped.filter(early))
    found = [(b.rows, b.first, b.last) for b in target.state().batches]
    return spark.createDataFrame(found, "n bigint, first string, last string").select(
        "n", *[F.col(c).cast("timestamp_ntz").alias(f"{c}_ts") for c in ("first", "last")]
    )


def _loaded(spark, sf_dir, label, *cycles, kind=PathTarget, **options):
    """Target after one cycle for each version of the source."""
    target = kind(spark, new_folder(spark, label))
    reports = [cycle.run_cycle(rows, target, sample_index(spark), **options) for rows in cycles]
    return target.read(), reports


def incremental_cycle(spark, sf_dir):
    """Two loads and one with nothing new make one full load."""
    everything = pings(spark, sf_dir)
    first = everything.filter(F.col("timestamp") <= parsing.ntz(MARK))
    return _loaded(spark, sf_dir, "cycle", first, everything, everything)[0]


def logged_cycle(spark, sf_dir):
    """The same cycles into a target with a log."""
    everything = pings(spark, sf_dir)
    first = everything.filter(F.col("timestamp") <= parsing.ntz(MARK))
    return _loaded(spark, sf_dir, "logged-cycle", first, everything, everything, kind=LoggedTarget)[0]


def _slow_arrival(spark, sf_dir):
    everything = pings(spark, sf_dir)
    seen = (F.col("timestamp") <= parsing.ntz(MARK)) & (F.col("network_type") != SLOW_NETWORK)
    return everything.filter(seen), everything


def late_rows_dropped(spark, sf_dir):
    return _loaded(spark, sf_dir, "late", *_slow_arrival(spark, sf_dir))[0]


def late_rows_recovered(spark, sf_dir):
    versions = _slow_arrival(spark, sf_dir)
    return _loaded(spark, sf_dir, "lookback", *versions, lookback=LOOKBACK)[0]


def run_metrics(spark, sf_dir):
    everything = pings(spark, sf_dir)
    _, (report,) = _loaded(spark, sf_dir, "metrics", everything)
    return spark.createDataFrame(
        [(report.extracted, report.loaded)], "extracted bigint, loaded bigint"
    )


def stream_cycle(spark, sf_dir):
    """Pages landed in two steps, each worked through by the stream."""
    pages, state = new_folder(spark, "stream-pages"), new_folder(spark, "stream-state")
    target = PathTarget(spark, new_folder(spark, "stream-target"))
    everything = pings(spark, sf_dir)
    early = F.col("timestamp") < parsing.ntz(MARK)
    for step, rows in enumerate([everything.filter(early), everything.filter(~early)]):
        source.write_pages(rows, f"{pages}/step={step}")
        stream = source.stream_pages(spark, f"{pages}/*", multi_line=False)
        start_stream(stream, target, sample_index(spark), state).awaitTermination()
    return target.read()


def late_rows_stream(spark, sf_dir):
    """Pings that land again and late: those within the lookback are loaded, once."""
    pages, state = new_folder(spark, "late-pages"), new_folder(spark, "late-state")
    target = LoggedTarget(spark, new_folder(spark, "late-target"))
    for step, rows in enumerate(_slow_arrival(spark, sf_dir)):
        source.write_pages(rows, f"{pages}/step={step}")
        stream = source.stream_pages(spark, f"{pages}/*", multi_line=False)
        start_stream(stream, target, sample_index(spark), state, lookback=LOOKBACK).awaitTermination()
    return target.read()


QUERIES: dict[str, Query] = {
    "enriched_pings": enriched_pings,
    "output_shape": output_shape,
    "fill_labels": fill_labels,
    "category_rollup": category_rollup,
    "zone_of_ping": zone_of_ping,
    "zone_boundary": zone_boundary,
    "zone_slanted_edges": zone_slanted_edges,
    "zone_empty": zone_empty,
    "zone_table": zone_table,
    "zone_of_ping_many_zones": zone_of_ping_many_zones,
    "zone_of_ping_shuffled": zone_of_ping_shuffled,
    "altitude_bin": _bin("altitude", bins.altitude_bin, "altitud_categoria"),
    "coverage_bin": _bin("signal", bins.coverage_bin, "cobertura_categoria"),
    "speed_bin": _bin("speed", bins.speed_bin, "velocidad_categoria"),
    "battery_bin": _bin("battery", bins.battery_bin, "bateria_categoria"),
    "operator_class": _bin("sim_operator", bins.operator_class, "compania"),
    "coordinate_parse": coordinate_parse,
    "parse_timestamps": parse_timestamps,
    "format_timestamps": format_timestamps,
    "full_scan": full_scan,
    "incremental_scan": incremental_scan,
    "page_scan": page_scan,
    "csv_scan": csv_scan,
    "offset_page": offset_page,
    "offset_pages_of_equal_keys": offset_pages_of_equal_keys,
    "keyset_page": keyset_page,
    "keyset_full_pull": keyset_full_pull,
    "keyset_pull_resumed": keyset_pull_resumed,
    "union_pages": union_pages,
    "drop_missing_id": drop_missing_id,
    "target_high_water_mark": target_high_water_mark,
    "next_id": next_id,
    "append_with_ids": append_with_ids,
    "append_roundtrip": append_roundtrip,
    "seed_roundtrip": seed_roundtrip,
    "incremental_cycle": incremental_cycle,
    "late_rows_dropped": late_rows_dropped,
    "late_rows_recovered": late_rows_recovered,
    "run_metrics": run_metrics,
    "stream_cycle": stream_cycle,
    "zone_of_ping_crowded": zone_of_ping_crowded,
    "logged_append": logged_append,
    "logged_replace": logged_replace,
    "logged_mark": logged_mark,
    "logged_cycle": logged_cycle,
    "late_rows_stream": late_rows_stream,
}
