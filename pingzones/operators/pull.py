"""Pulling a growing table page by page, with the place kept between runs.

A run makes one directory of the rows behind the place where the last run ended and
hands out its pages in order.  A page is written before it is handed out, and its
end after: whatever dies in between, the next run hands out the same rows under the
same number, so a receiver that knows the numbers it has (``append_once``) takes
every row once.  Places are keys of all columns, so rows that share a time, or are
copies, are neither lost nor repeated at a page edge.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingzones.operators import paging
from pingzones.operators.shared_folder import create_text, list_names, path_exists, read_text, release, written

_DIGITS = 12


def _place(spark: SparkSession, log: str) -> tuple[int, paging.Edge | None]:
    """Number of the next page, and where it starts; no edge before the first run."""
    ends = sorted(n for n in list_names(spark, log) if n.endswith(".json"))
    if not ends:
        return 0, None
    kept = json.loads(read_text(spark, f"{log}/{ends[-1]}"))
    if kept["timestamp"] is not None:
        kept["timestamp"] = datetime.fromisoformat(kept["timestamp"])
    return int(ends[-1].removesuffix(".json")), paging.Edge(**kept)


def _behind(page: DataFrame, start: paging.Edge | None) -> paging.Edge:
    """The edge behind the last row of a page, if nothing is known to follow."""
    keyed = paging.with_row_hash(page)
    last = keyed.orderBy(*[F.col(k).desc_nulls_first() for k in paging.KEY]).first()
    edge = paging.Edge(*[last[k] for k in paging.KEY], 0)
    held = keyed.filter(edge.same()).count() + (start.skip if edge.shares_key(start) else 0)
    return paging.Edge(edge.timestamp, edge.id, edge.row, held)


def _keep(spark: SparkSession, log: str, number: int, place: paging.Edge) -> None:
    kept = asdict(place)
    if kept["timestamp"] is not None:
        kept["timestamp"] = kept["timestamp"].isoformat()
    if not create_text(spark, f"{log}/{number:0{_DIGITS}}.json", json.dumps(kept)):
        raise RuntimeError(f"{log}: another run has handed out page {number - 1}")


def pull(
    pings: DataFrame, log: str, receive: Callable[[DataFrame, int], None], size: int = paging.PAGE_SIZE
) -> int:
    """Hand the rows behind the place kept in folder ``log`` to ``receive(page, number)``; returns the pages handed out.

    Rows that arrive with a key before that place are not pulled any more.
    """
    spark = pings.sparkSession
    number, place = _place(spark, log)
    first = number
    folder = lambda: f"{log}/page={number}"

    def hand_out(end: paging.Edge | None, start: paging.Edge | None) -> None:
        nonlocal number, place
        page = spark.read.schema(pings.schema).parquet(folder())
        receive(page, number)
        place = end or _behind(page, start)
        _keep(spark, log, number + 1, place)
        release(spark, folder())
        number += 1

    if path_exists(spark, f"{folder()}/_SUCCESS"):
        # A run before this one died while the page was received.
        hand_out(None, place)
    release(spark, folder())
    directory = paging.page_directory(pings, size, place)
    edges = [paging.edge_of(r) for r in directory.orderBy("page").toLocalIterator()]
    for start, end in zip(edges, [*edges[1:], None]):
        written(paging.rows_between(pings, start, end, size), folder())
        hand_out(end, start)
    return number - first
