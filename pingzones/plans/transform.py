"""From source pings to the labelled output table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from pingzones.functions import bins
from pingzones.operators.zone_index import ZoneIndex
from pingzones.operators.zone_join import BROADCAST_LIMIT, fits_broadcast, with_zone
from pingzones.schema import (
    DEFAULT_THRESHOLDS,
    LABEL_COLUMNS,
    OUTPUT_COLUMNS,
    PASS_THROUGH,
    UNKNOWN,
    Thresholds,
)


def category_columns(t: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, Column]:
    """The five categories that depend on the ping alone."""
    return {
        "altitud_categoria": bins.altitude_bin("altitude", t),
        "cobertura_categoria": bins.coverage_bin("signal", t),
        "velocidad_categoria": bins.speed_bin("speed", t),
        "bateria_categoria": bins.battery_bin("battery", t),
        "compania": bins.operator_class("sim_operator"),
    }


def output_shape(labelled: DataFrame) -> DataFrame:
    """Output names and order; columns the output does not have are left behind."""
    source = {c: PASS_THROUGH.get(c, c) for c in OUTPUT_COLUMNS}
    return labelled.selectExpr(*[f"`{s}` AS {c}" for c, s in source.items()])


def fill_labels(df: DataFrame) -> DataFrame:
    """Missing labels become the fixed unknown label."""
    return df.fillna({c: UNKNOWN for c in LABEL_COLUMNS if c in df.columns})


def label_pings(
    pings: DataFrame,
    index: ZoneIndex,
    t: Thresholds = DEFAULT_THRESHOLDS,
    broadcast_limit: int = BROADCAST_LIMIT,
    **join_options,
) -> DataFrame:
    """Zone and categories for every ping, in the output schema."""
    categories = category_columns(t)
    join_options["broadcast_limit"] = broadcast_limit
    if fits_broadcast(index, broadcast_limit):
        # Below the join the categories share its generated code; the zone label's
        # array functions are interpreted and would take them along.
        labelled = with_zone(pings.withColumns(categories), index, **join_options)
    else:
        # Above a shuffle they do not widen the shuffled rows.
        labelled = with_zone(pings, index, **join_options).withColumns(categories)
    return fill_labels(output_shape(labelled))
