"""Pages of a ping table in the order (timestamp, id), nulls last.

A single page by key or offset is a query of its own.  Whoever reads many pages by
number makes a directory of their first rows once; each page is then a range.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingzones.functions.parsing import ntz
from pingzones.operators.numbering import with_row_index
from pingzones.operators.shared_folder import new_folder, written

PAGE_SIZE = 5000
# Rows a page may skip by sorting; further offsets are first narrowed by counting.
MAX_SKIP = 100_000
_BUCKETS = 1024
_ROW = "_row_hash"

Key = tuple[datetime | None, int | None]


def newer_than(pings: DataFrame, mark: datetime | None, column: str = "timestamp") -> DataFrame:
    """Rows strictly after the high-water mark; all rows when there is none."""
    return pings if mark is None else pings.filter(F.col(column) > ntz(mark))


def _after(column: str, value: Column | None, rest: Column) -> Column:
    """Row order test for one key: later, or equal and then decided by ``rest``."""
    c = F.col(column)
    if value is None:
        return c.isNull() & rest
    # The first part alone reaches the scan as a range filter.
    return (c.isNull() | (c >= value)) & (c.isNull() | (c > value) | rest)


def _ordered(pings: DataFrame) -> DataFrame:
    return pings.orderBy(F.col("timestamp").asc_nulls_last(), F.col("id").asc_nulls_last())


def keyset_page(pings: DataFrame, after: Key | None = None, size: int = PAGE_SIZE) -> DataFrame:
    """The ``size`` rows that follow the key of the last row of the page before.

    The key is the pair (timestamp, id), so rows that share the time of a page
    edge are not passed over.
    """
    if after is not None:
        time, id_ = after
        later_id = F.lit(False) if id_ is None else F.col("id").isNull() | (F.col("id") > id_)
        pings = pings.filter(_after("timestamp", None if time is None else ntz(time), later_id))
    return _ordered(pings).limit(size)


def _descend(rows: DataFrame, key: Column, rank: int, distance, literal, max_skip: int) -> tuple:
    """Narrow to the value range of ``key`` that holds the row number ``rank``.

    Counts rows in equal-width ranges and goes into the right one until it is
    small or a single value.  Returns (low, high, rank within, rows within);
    low and high are None when the row is among the null keys.
    """
    keyed = rows.withColumn("_key", key)
    s = keyed.agg(
        F.count("_key").alias("n"), F.count(F.lit(1)).alias("total"),
        F.min("_key").alias("lo"), F.max("_key").alias("hi"),
    ).first()
    if rank >= s["n"]:
        return None, None, rank - s["n"], s["total"] - s["n"]
    low, high, n = s["lo"], s["hi"], s["n"]
    while n > max_skip and low != high:
        # At most _BUCKETS + 1 rows; the bounds come from the data itself.
        ranges = (
            keyed.filter(F.col("_key").between(literal(low), literal(high)))
            .groupBy(distance(F.col("_key"), low, high).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("lo"), F.max("_key").alias("hi"))
            .orderBy("bucket")
            .collect()
        )
        for r in ranges:
            if rank < r["n"]:
                low, high, n = r["lo"], r["hi"], r["n"]
                break
            rank -= r["n"]
    return low, high, rank, n


def _time_bucket(c: Column, low: datetime, high: datetime) -> Column:
    return F.width_bucket(c - ntz(low), F.make_dt_interval(), F.lit(high - low), F.lit(_BUCKETS))


def _number_bucket(c: Column, low: int, high: int) -> Column:
    # Subtract before going to double, which keeps close large numbers apart.
    offset = (c.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")).cast("double")
    return F.width_bucket(offset, F.lit(0.0), F.lit(float(high - low)), F.lit(_BUCKETS))


def offset_page(pings: DataFrame, offset: int, size: int = PAGE_SIZE, max_skip: int | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + size`` of the table, ordered by time, id and row hash.

    The hash is over all columns, so only rows that are equal in every one have
    no order among them, and consecutive pages cover the table once.  Small
    offsets are a plain top-k.  For a large one, counting passes find the key
    range that the page starts in, so the skipped rows are counted where they
    lie and never sorted or brought together.  ``max_skip`` changes the way, not
    the rows.
    """
    max_skip = MAX_SKIP if max_skip is None else max_skip
    keyed = pings.withColumn(_ROW, F.xxhash64(*pings.columns))
    ordered = lambda rows: rows.orderBy(*[F.col(k).asc_nulls_last() for k in ("timestamp", "id", _ROW)])
    start, rank = F.lit(True), offset
    if offset + size > max_skip:
        same, later = F.lit(True), F.lit(False)
        for name, distance, literal in (
            ("timestamp", _time_bucket, ntz), ("id", _number_bucket, F.lit), (_ROW, _number_bucket, F.lit),
        ):
            key = F.col(name)
            low, _, rank, n = _descend(keyed.filter(same), key, rank, distance, literal, max_skip)
            reached = key.isNull() if low is None else key.isNull() | (key >= literal(low))
            start = later | (same & reached)
            if n <= max_skip:
                break
            # One value with very many rows: go on by the next key.
            later = later | (same & (F.lit(False) if low is None else key.isNull() | (key > literal(low))))
            same = same & (key.isNull() if low is None else key == literal(low))
        else:  # rows equal in every column; any of them will do
            taken = min(size, n - rank)
            rest = ordered(keyed.filter(later)).limit(size - taken)
            return keyed.filter(same).limit(taken).unionByName(rest).drop(_ROW)
    return ordered(keyed.filter(start)).offset(rank).limit(size).drop(_ROW)


KEY = ("timestamp", "id", _ROW)


@dataclass(frozen=True)
class Edge:
    """Where a page starts: behind ``skip`` of the rows that have this key."""

    timestamp: datetime | None
    id: int | None
    row: int
    skip: int

    @property
    def key(self) -> list[tuple[str, Column | None]]:
        """Name and literal of each part of the key; no literal for a null."""
        time = None if self.timestamp is None else ntz(self.timestamp)
        return list(zip(KEY, (time, None if self.id is None else F.lit(self.id), F.lit(self.row))))

    def same(self) -> Column:
        return reduce(and_, [F.col(k).isNull() if v is None else F.col(k) == v for k, v in self.key])

    def beyond(self) -> Column:
        return reduce(lambda rest, kv: _after(*kv, rest), reversed(self.key), F.lit(False))

    def before(self) -> Column:
        def earlier(rest: Column, kv) -> Column:
            c, value = F.col(kv[0]), kv[1]
            return c.isNotNull() | rest if value is None else (c <= value) & ((c < value) | rest)

        return reduce(earlier, reversed(self.key), F.lit(False))

    def shares_key(self, other: Edge | None) -> bool:
        return other is not None and (self.timestamp, self.id, self.row) == (other.timestamp, other.id, other.row)


def with_row_hash(pings: DataFrame) -> DataFrame:
    return pings.withColumn(_ROW, F.xxhash64(*[F.col(f"`{c}`") for c in pings.columns]))


def page_directory(pings: DataFrame, size: int = PAGE_SIZE, start: Edge | None = None) -> DataFrame:
    """The first row of every page, written: (page, timestamp, id, row, skip).

    One pass numbers the sort keys of all rows, or of those from ``start`` on; of
    equal keys only the first number and the count are kept, however many copies
    there are.
    """
    keyed = with_row_hash(pings)
    if start is not None:
        keyed = keyed.filter(start.same() | start.beyond())
    numbered = with_row_index(keyed.select(*KEY), "_index", [F.col(k).asc_nulls_last() for k in KEY])
    runs = numbered.groupBy(*KEY).agg(
        (F.min("_index") - (start.skip if start else 0)).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    first_page = F.greatest(F.lit(0).cast("long"), F.ceil(F.col("first") / size))
    last_page = F.floor((F.col("first") + F.col("copies") - 1) / size)
    starting = runs.filter(first_page <= last_page).select(
        F.explode(F.sequence(first_page, last_page)).alias("page"), *KEY, "first"
    )
    edges = starting.select(
        "page", "timestamp", "id", F.col(_ROW).alias("row"), (F.col("page") * size - F.col("first")).alias("skip")
    )
    return written(edges, new_folder(pings.sparkSession, "page-directory"))


def edge_of(row) -> Edge:
    return Edge(row["timestamp"], row["id"], row["row"], row["skip"])


def rows_between(pings: DataFrame, start: Edge, end: Edge | None, size: int) -> DataFrame:
    """The page of at most ``size`` rows from one edge to another, in order.

    The edges bound a range that reaches the scan.  Rows equal to an edge in every
    column are interchangeable, so as many of them as the page has are taken
    without sorting them.
    """
    keyed = with_row_hash(pings)
    if end is not None and end.timestamp is not None:
        # Said of the time alone, it reaches the scan.
        keyed = keyed.filter(F.col("timestamp") >= ntz(start.timestamp))
    if start.shares_key(end):
        parts = [keyed.filter(start.same()).limit(end.skip - start.skip)]
    else:
        taken = keyed.filter(start.same()).offset(start.skip).limit(size)
        parts = [taken, keyed.filter(start.beyond() if end is None else start.beyond() & end.before())]
        if end is not None and end.skip:
            parts.append(keyed.filter(end.same()).limit(end.skip))
    return reduce(DataFrame.unionByName, parts).orderBy(*[F.col(k).asc_nulls_last() for k in KEY]).drop(_ROW)


def directory_page(pings: DataFrame, directory: DataFrame, page: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``page`` (from 0) of the table that the directory was made of; empty beyond the last one."""
    edges = {r["page"]: edge_of(r) for r in directory.filter(F.col("page").isin(page, page + 1)).collect()}
    if page not in edges:
        return pings.limit(0)
    return rows_between(pings, edges[page], edges.get(page + 1), size)
