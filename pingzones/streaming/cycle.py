"""The load cycle as a stream: newly landed pings are labelled and appended.

The stream's checkpoint takes the place of the high-water mark, so late pings
are loaded too.  The label step keeps no state and the zone index is built once.
With a lookback the stream knows the pings of that time: one that comes again is
dropped, and so is one that comes later than that.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pingzones.operators.shared_folder import mark_path, path_exists
from pingzones.operators.zone_index import ZoneIndex
from pingzones.plans.cycle import counted, not_loaded
from pingzones.plans.transform import label_pings
from pingzones.schema import DEFAULT_THRESHOLDS, Thresholds
from pingzones.sinks.targets import Target


# Stands for the time of pings without one: they are late for all but the first batch.
_NO_TIME = "1970-01-01 00:00:00.001"


@dataclass(frozen=True)
class BatchReport:
    batch_id: int
    extracted: int
    loaded: int


def within_lookback(pings: DataFrame, lookback: timedelta) -> DataFrame:
    """Each ping of a stream once, unless it is late by ``lookback`` or more.

    Late is measured from the latest time of the batches before, in milliseconds, as
    a watermark is.  State is kept for pings within the lookback: 16 bytes of hash
    of all columns for each, so pings equal in every column count as one.  Pings
    without a time are loaded by the first batch only.
    """
    # The wall clock as if it were UTC: an event time has to be an instant.
    time = F.coalesce("timestamp", F.lit(_NO_TIME).cast("timestamp_ntz"))
    clock = F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time))
    keys = {"_key_a": F.xxhash64(*pings.columns), "_key_b": F.xxhash64(F.lit("b"), *reversed(pings.columns))}
    keyed = pings.withColumns({"_clock": clock, **keys})
    late_by = f"{int(lookback.total_seconds() * 1000)} milliseconds"
    return keyed.withWatermark("_clock", late_by).dropDuplicatesWithinWatermark([*keys]).drop("_clock", *keys)


class _BatchWriter:
    """Appends batches; a batch that runs again is not appended again.

    A target with a log is told the stream and the batch, and knows.  For others: a
    query that stops between the append and the commit of a batch runs that
    batch again at its next start.  Marks in the checkpoint tell: a batch marked
    as appended is passed over, and one marked as begun only, of which all or
    some rows may be in the target, is compared with the target over the times
    it spans.  Every other batch is appended as it is, copies included.
    """

    def __init__(
        self, target: Target, index: ZoneIndex, thresholds: Thresholds, checkpoint: str, reports: list[BatchReport]
    ):
        self.target, self.index, self.thresholds, self.reports = target, index, thresholds, reports
        self.checkpoint, self.marks = checkpoint, f"{checkpoint}/appended"

    def _labelled(self, batch: DataFrame):
        """The labelled rows, and what counts them in passing."""
        batch, extracted = counted(batch, "extracted")
        out, loaded = counted(label_pings(batch, self.index, self.thresholds), "loaded")
        return out, lambda batch_id: BatchReport(batch_id, extracted.get["rows"], loaded.get["rows"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        out, report = self._labelled(batch)
        appended = self.target.append_once(out, self.checkpoint, batch_id)
        if appended is not None:
            if appended:
                self.reports.append(report(batch_id))
            return
        begun, ended = (f"{self.marks}/{batch_id}.{state}" for state in ("begun", "ended"))
        if path_exists(spark, ended):
            return
        if path_exists(spark, begun) and self.target.exists():
            out, report = self._labelled(self._unrepeated(batch))
        mark_path(spark, begun)
        self.target.append(out)
        mark_path(spark, ended)
        self.reports.append(report(batch_id))

    def _unrepeated(self, batch: DataFrame) -> DataFrame:
        span = batch.agg(
            F.min("timestamp").alias("lo"),
            F.max("timestamp").alias("hi"),
            F.count_if(F.col("timestamp").isNull()).alias("untimed"),
        ).first()
        # Rows without a time can be anywhere in the target.
        low, high = (None, None) if span["untimed"] else (span["lo"], span["hi"])
        return not_loaded(batch, self.target.read(), low, high)


def start_stream(
    pings: DataFrame,
    target: Target,
    index: ZoneIndex,
    checkpoint: str,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
    available_now: bool = True,
    interval: str = "1 minute",
    lookback: timedelta | None = None,
    reports: list[BatchReport] | None = None,
) -> StreamingQuery:
    """Start the stream; by default it works through what has landed and ends.

    ``lookback`` drops repeated and very late pings (``within_lookback``); without
    it everything that lands is loaded.  ``reports`` gets the counts of each batch
    as it is appended, taken in the pass that writes it.
    """
    if lookback is not None:
        pings = within_lookback(pings, lookback)
    write = _BatchWriter(target, index, thresholds, checkpoint, [] if reports is None else reports)
    writer = pings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
