"""Ping tables from JDBC, landed response pages, CSV, Parquet or the catalog."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from pingzones.functions.parsing import DEFAULT_ZONE, format_timestamp, instant_to_clock, parse_iso_timestamp
from pingzones.operators.paging import newer_than
from pingzones.schema import PING_COLUMNS, PING_SCHEMA

BAD_ROW = "_corrupt_record"
FETCH_SIZE = 10_000

# Times are read as text first: they may or may not carry an offset.
PAGE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
        for f in PING_SCHEMA
    ]
)


def empty_pings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PING_SCHEMA)


def conform(df: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """The ping columns in order, bound by name and cast to their types.

    A time that is stored as an instant becomes the wall clock of ``zone``.
    """
    instant = isinstance(df.schema["timestamp"].dataType, T.TimestampType)

    def column(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        return (instant_to_clock(c, zone) if instant and f.name == "timestamp" else c.cast(f.dataType)).alias(f.name)

    return df.select(*[column(f) for f in PING_SCHEMA])


def _newer(df: DataFrame, mark: datetime | None, zone: str) -> DataFrame:
    """Rows of a raw table after the mark, a wall clock of ``zone``.

    The filter compares the column as it is stored, so it reaches the scan.
    """
    if mark is None or not isinstance(df.schema["timestamp"].dataType, T.TimestampType):
        return newer_than(conform(df, zone), mark)
    # Where clocks go back a wall clock names two instants; the filter on the clock decides.
    earliest = mark.replace(tzinfo=ZoneInfo(zone)).astimezone(timezone.utc) - timedelta(hours=3)
    instant = F.lit(earliest.strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")
    return newer_than(conform(df.filter(F.col("timestamp") > instant), zone), mark)


# --- landed response pages -------------------------------------------------


def _page_reader(reader, multi_line: bool, keep_bad_rows: bool):
    schema = PAGE_SCHEMA
    if keep_bad_rows:
        schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField(BAD_ROW, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
    return (
        reader.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE" if keep_bad_rows else "FAILFAST")
    )


def _typed_pages(raw: DataFrame, zone: str, keep_bad_rows: bool) -> DataFrame:
    text = F.col("timestamp")
    parsed = parse_iso_timestamp(text, zone)
    unreadable = text.isNotNull() & parsed.isNull()
    if keep_bad_rows:
        flagged = F.coalesce(BAD_ROW, F.when(unreadable, F.concat(F.lit("timestamp: "), text)))
        raw = raw.withColumn(BAD_ROW, flagged)
    else:
        failure = F.raise_error(F.concat(F.lit("unreadable timestamp: "), text))
        parsed = F.when(unreadable, failure.cast("timestamp_ntz")).otherwise(parsed)
    return raw.withColumn("timestamp", parsed)


def read_pages(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    zone: str = DEFAULT_ZONE,
    keep_bad_rows: bool = False,
    landed_after: str | None = None,
) -> DataFrame:
    """Landed JSON pages: arrays of objects, or one object a line.

    Keys bind by name in any order and nulls stay null.  A row that does not fit
    fails the read, unless ``keep_bad_rows`` asks for it in a text column.
    ``landed_after`` (a time as text) leaves out files last changed before it,
    which a later cycle need not read again.
    """
    reader = _page_reader(spark.read, multi_line, keep_bad_rows)
    if landed_after:
        reader = reader.option("modifiedAfter", landed_after)
    raw = reader.json(path)
    return _typed_pages(raw, zone, keep_bad_rows)


def stream_pages(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    zone: str = DEFAULT_ZONE,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same pages as a stream of newly landed files."""
    reader: DataStreamReader = _page_reader(spark.readStream, multi_line, False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _typed_pages(reader.json(path), zone, False)


# --- CSV and Parquet -------------------------------------------------------


def read_csv(spark: SparkSession, path: str, zone: str = DEFAULT_ZONE) -> DataFrame:
    """CSV with a header, bound by column name.

    The header is taken from the first file and checked against every other one,
    so files whose columns are ordered differently fail instead of being misread.
    Whole numbers may be written with a fraction of zero (``75.0``), as exports
    of columns with gaps often are; any other fraction fails.
    """
    header = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in PAGE_SCHEMA}
    whole = [c for c in header if types.get(c) == T.IntegerType()]
    schema = T.StructType(
        [
            T.StructField(c, T.DoubleType() if c in whole else types.get(c, T.StringType()))
            for c in header
        ]
    )
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return conform(_typed_pages(raw, zone, False).withColumns({c: _whole_number(c) for c in whole}))


def _whole_number(name: str) -> Column:
    c = F.col(name)
    failure = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), c.cast("string")))
    return F.when(c.isNull() | (c == F.floor(c)), c.cast("int")).otherwise(failure.cast("int"))


def read_parquet(
    spark: SparkSession, path: str, mark: datetime | None = None, zone: str = DEFAULT_ZONE
) -> DataFrame:
    return _newer(spark.read.parquet(path), mark, zone)


def read_table(
    spark: SparkSession, name: str, mark: datetime | None = None, zone: str = DEFAULT_ZONE
) -> DataFrame:
    return _newer(spark.table(name), mark, zone)


# --- JDBC ------------------------------------------------------------------


def _jdbc_range(
    spark: SparkSession, url: str, table: str, mark: datetime | None, properties: dict[str, str]
) -> Row:
    """Lowest and highest id and row count of the wanted rows, computed by the database."""
    where = ""
    if mark is not None:
        where = f" WHERE \"timestamp\" > '{mark.strftime('%Y-%m-%d %H:%M:%S.%f')}'"
    query = f"SELECT MIN(id) AS lo, MAX(id) AS hi, COUNT(*) AS n FROM {table}{where}"
    return spark.read.format("jdbc").options(url=url, query=query, **properties).load().first()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    mark: datetime | None = None,
    properties: dict[str, str] | None = None,
    rows_per_partition: int = 500_000,
    max_connections: int = 32,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Parallel scan of a database table, split on ranges of ``id``.

    The filter on the time is typed, so Spark pushes it to the database.
    """
    properties = properties or {}
    r = _jdbc_range(spark, url, table, mark, properties)
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, fetchsize=str(FETCH_SIZE), preferTimestampNTZ="true", **properties
    )
    parts = min(max_connections, -(-int(r["n"]) // rows_per_partition))
    if parts > 1 and r["lo"] is not None and r["lo"] < r["hi"]:
        reader = reader.options(
            partitionColumn="id",
            lowerBound=str(r["lo"]),
            upperBound=str(r["hi"] + 1),
            numPartitions=str(parts),
        )
    return _newer(reader.load(), mark, zone)


# --- one entry point -------------------------------------------------------

_READERS = {
    "jdbc": read_jdbc,
    "pages": read_pages,
    "csv": read_csv,
    "parquet": read_parquet,
    "table": read_table,
}


def read_pings(
    spark: SparkSession, source: str, mark: datetime | None = None, **options
) -> DataFrame:
    """Pings of a source, only those newer than ``mark`` when one is given."""
    if source not in _READERS:
        raise ValueError(f"unknown source {source!r}; use one of {sorted(_READERS)}")
    if source in ("jdbc", "parquet", "table"):
        return _READERS[source](spark, mark=mark, **options)
    return newer_than(_READERS[source](spark, **options), mark)


def union_pages(pages: list[DataFrame]) -> DataFrame:
    """All rows of several pages, matched by column name."""
    return reduce(DataFrame.unionByName, pages)


def write_pages(pings: DataFrame, path: str) -> None:
    """Land pings as JSON lines with ISO-8601 times and every key present."""
    pings.select(*PING_COLUMNS).withColumn(
        "timestamp", format_timestamp(F.col("timestamp"), "T")
    ).write.option("ignoreNullFields", False).json(path)


def drop_missing_id(pings: DataFrame) -> DataFrame:
    return pings.dropna(subset=["id"])
