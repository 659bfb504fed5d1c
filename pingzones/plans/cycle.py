"""One load cycle: high-water mark, newer pings, labels, append."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from pingzones.functions import bins
from pingzones.functions.parsing import ntz
from pingzones.operators.paging import newer_than
from pingzones.operators.zone_index import ZoneIndex
from pingzones.plans.transform import label_pings
from pingzones.schema import DEFAULT_THRESHOLDS, PASS_THROUGH, Thresholds
from pingzones.sinks.targets import Conflict, Target


@dataclass(frozen=True)
class CycleReport:
    mark: datetime | None
    extracted: int
    loaded: int
    # Another cycle changed the target meanwhile: nothing was loaded.
    conflict: bool = False


def not_loaded(
    pings: DataFrame, target: DataFrame, low: datetime | None, high: datetime | None
) -> DataFrame:
    """Pings that the target holds fewer times than ``pings`` does.

    Compared are the values that the target carries unchanged and the operator,
    which depends on the ping alone; of n equal pings the target has m of, n - m
    are left.  Only the part of the target between ``low`` and ``high`` is read;
    the caller guarantees that the pings lie there.  Zones are not compared, so a
    changed zone file does not make loaded pings look new.
    """
    names = {**PASS_THROUGH, "compania": "_operator"}
    known = target.select(*[F.col(o).alias(f"_known_{s}") for o, s in names.items()])
    if low is not None:
        known = known.filter(F.col("_known_timestamp").between(ntz(low), ntz(high)))
    # Copies are folded map-side.
    counts = known.groupBy(*known.columns).agg(F.count(F.lit(1)).alias("_held"))
    of_equal = Window.partitionBy(*names.values()).orderBy(F.lit(1))
    numbered = pings.withColumn("_operator", bins.operator_class("sim_operator")).withColumn(
        "_copy", F.row_number().over(of_equal)
    )
    on = [F.col(s).eqNullSafe(F.col(f"_known_{s}")) for s in names.values()]
    left = numbered.join(counts, on, "left").filter("_held IS NULL OR _copy > _held")
    return left.select(*[f"`{c}`" for c in pings.columns])


def pending(
    pings: DataFrame, target: Target, mark: datetime | None, lookback: timedelta | None = None
) -> DataFrame:
    """Rows to load: newer than the mark, plus missed ones within ``lookback``.

    Rows after the mark cannot be in the target yet, so only the late window is
    compared with it.
    """
    fresh = newer_than(pings, mark)
    if mark is None or not lookback:
        return fresh
    low = mark - lookback
    late = pings.filter(
        (F.col("timestamp") > ntz(low)) & (F.col("timestamp") <= ntz(mark))
    )
    return fresh.unionByName(not_loaded(late, target.read(), low, mark))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows in passing, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def run_cycle(
    pings: DataFrame,
    target: Target,
    index: ZoneIndex,
    lookback: timedelta | None = None,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
) -> CycleReport:
    """Load what the target lacks.

    By default a ping that arrives with a time at or before the mark is never
    loaded.  ``lookback`` loads such pings if they are at most that much older,
    and also completes an append that failed half way.  A target with a log needs
    no lookback for that, and of two cycles that overlap it lets one through.
    """
    found = target.snapshot()
    mark = found.mark
    rows = pending(pings, target, mark, lookback)
    if rows.isEmpty():
        return CycleReport(mark, 0, 0)
    rows, extracted = counted(rows, "extracted")
    out, loaded = counted(label_pings(rows, index, thresholds), "loaded")
    try:
        found.append(out)
    except Conflict:
        return CycleReport(mark, extracted.get["rows"], 0, conflict=True)
    return CycleReport(mark, extracted.get["rows"], loaded.get["rows"])


def category_rollup(labelled: DataFrame) -> DataFrame:
    """Pings per zone and operator: a consumer of the output, partly aggregated map-side."""
    return labelled.groupBy("zona", "compania").agg(F.count(F.lit(1)).alias("pings"))

