"""Pulling page by page: ends, restarts, ties and copies."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pingzones.catalog import derived
from pingzones.operators.pull import pull
from pingzones.schema import PING_SCHEMA
from pingzones.sinks.logged import LoggedTarget

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def pings(spark, tiny):
    """Whole days, so that many rows share a time; copies; rows without a time or an id."""
    daily = derived.pings(spark, tiny).withColumn("timestamp", F.date_trunc("day", "timestamp").cast("timestamp_ntz"))
    odd = daily.limit(7).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    return daily.unionByName(daily.filter("battery IS NULL")).unionByName(odd.withColumn("id", F.lit(None).cast("int"))).cache()


def rows(df):
    return sorted(map(str, df.collect()))


class Receiver:
    """Keeps the pages; dies at a call, before or after it has taken the page."""

    def __init__(self, spark, path, dies_at=None, taken=False):
        self.target = LoggedTarget(spark, str(path), PING_SCHEMA, "timestamp")
        self.sizes, self.calls, self.dies_at, self.taken = [], 0, dies_at, taken

    def __call__(self, page, number):
        self.calls += 1
        dies = self.calls - 1 == self.dies_at
        if dies and not self.taken:
            raise KeyboardInterrupt
        if self.target.append_once(page, "pull", number):
            self.sizes.append(page.count())
        if dies:
            raise KeyboardInterrupt


def test_every_row_once(spark, pings, tmp_path):
    receiver = Receiver(spark, tmp_path / "target")
    n = pings.count()
    assert pull(pings, str(tmp_path / "log"), receiver, 300) == -(-n // 300)
    assert receiver.sizes == [300] * (n // 300) + [n % 300]
    assert rows(receiver.target.read()) == rows(pings)
    assert pull(pings, str(tmp_path / "log"), receiver, 300) == 0


@pytest.mark.parametrize("taken", [False, True])
def test_a_restart_goes_on_where_the_last_run_died(spark, pings, tmp_path, taken):
    log, receiver = str(tmp_path / "log"), Receiver(spark, tmp_path / "target", 2, taken)
    with pytest.raises(KeyboardInterrupt):
        pull(pings, log, receiver, 300)
    assert receiver.target.read().count() == (900 if taken else 600)
    # Later rows have arrived meanwhile; the page that was handed out is the same again.
    more = pings.unionByName(pings.filter("speed IS NULL").withColumn("timestamp", F.lit("2030-01-01").cast("timestamp_ntz")))
    pull(more, log, receiver, 300)
    assert rows(receiver.target.read()) == rows(more)


def test_rows_that_arrive_at_the_place(spark, tmp_path):
    """More copies of the last row come later, and rows of the same time and id: none is lost."""
    def some(n, battery=1, day=0):
        kept = {"id": F.lit(5), "timestamp": F.lit(str(T0 + timedelta(days=day))).cast("timestamp_ntz"), "battery": F.lit(battery)}
        return spark.range(n).select(*[kept.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PING_SCHEMA])

    log, receiver = str(tmp_path / "log"), Receiver(spark, tmp_path / "target")
    versions = [some(5), some(12), some(12).unionByName(some(3, day=1)), some(12).unionByName(some(30, day=1))]
    for version in versions:
        pull(version, log, receiver, 4)
    assert receiver.sizes == [4, 1, 4, 3, 3, 4, 4, 4, 4, 4, 4, 3]
    assert rows(receiver.target.read()) == rows(versions[-1])


def test_nothing_to_pull(spark, pings, tmp_path):
    receiver = Receiver(spark, tmp_path / "target")
    assert pull(pings.limit(0), str(tmp_path / "log"), receiver) == 0 and receiver.calls == 0
