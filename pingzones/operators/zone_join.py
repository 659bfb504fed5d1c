"""First zone that strictly contains each ping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingzones.functions.geometry import rounding_bound, strictly_inside
from pingzones.functions.parsing import parse_coordinate
from pingzones.operators.skew import ROWS_PER_TASK, hot_keys, salted_left_join
from pingzones.operators.zone_index import WINNER_TYPE, ZoneIndex, deepest_cell, key_at
from pingzones.schema import BAD_COORDINATE, OUTSIDE, UNKNOWN

# An index above this size is joined by shuffling instead of broadcasting.
BROADCAST_LIMIT = 128 << 20


def _first_inside(near: str, lon: str, lat: str, bound: float) -> str:
    """Lowest zone of a cell whose edges enclose the point; stops at the first."""
    return f"""aggregate({near}, CAST(NULL AS {WINNER_TYPE}), (found, z) ->
        coalesce(found, CASE WHEN {strictly_inside('z.edges', lon, lat, bound)}
                             THEN named_struct('ord', z.ord, 'name', z.name) END))"""


def fits_broadcast(index: ZoneIndex, broadcast_limit: int = BROADCAST_LIMIT) -> bool:
    return index.bytes_estimate <= broadcast_limit


def _with_zone_of_text(pings, index, out, lat, lon, broadcast_limit, rows_per_task) -> DataFrame:
    numbers = {"_lat": parse_coordinate(F.col(lat)), "_lon": parse_coordinate(F.col(lon))}
    bad = (F.col(lat).isNotNull() & F.col("_lat").isNull()) | (F.col(lon).isNotNull() & F.col("_lon").isNull())
    zoned = with_zone(pings.withColumns(numbers), index, "_zone", "_lat", "_lon", broadcast_limit, rows_per_task)
    missing = F.col(lat).isNull() | F.col(lon).isNull()
    label = F.when(missing, UNKNOWN).when(bad, BAD_COORDINATE).otherwise(F.col("_zone"))
    return zoned.withColumn(out, label).drop("_lat", "_lon", "_zone")


def with_zone(
    pings: DataFrame,
    index: ZoneIndex,
    out: str = "zona",
    lat: str = "latitude",
    lon: str = "longitude",
    broadcast_limit: int = BROADCAST_LIMIT,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``pings`` with the zone label in column ``out``.

    Coordinates may be text: one that is no number gives the label of a bad
    coordinate.

    Within ``broadcast_limit`` the pings are not shuffled and not multiplied:
    each looks up its cell in a broadcast table.  Above it the pings are
    shuffled by cell, with salts for crowded cells.
    """
    kinds = dict(pings.dtypes)
    if "string" in (kinds[lat], kinds[lon]):
        return _with_zone_of_text(pings, index, out, lat, lon, broadcast_limit, rows_per_task)
    missing = f"{lat} IS NULL OR {lon} IS NULL"
    if index.is_empty:
        label = f"CASE WHEN {missing} THEN '{UNKNOWN}' ELSE '{OUTSIDE}' END"
        return pings.withColumn(out, F.expr(label))

    x0, x1, y0, y1 = (f"{b!r}D" for b in index.bounds)
    bound = rounding_bound(index.reach, index.extent)
    # NaN and anything off the map fails this test and gets no cell.
    on_map = f"{lon} BETWEEN {x0} AND {x1} AND {lat} BETWEEN {y0} AND {y1}"
    located = pings.withColumns(
        {at: F.expr(f"CASE WHEN {on_map} THEN {c} / {index.cell!r}D END") for at, c in (("_gx", lon), ("_gy", lat))}
    )
    located = located.withColumn("_z", F.expr(deepest_cell(index.depths, "_gx", "_gy"))).drop("_gx", "_gy")
    small = fits_broadcast(index, broadcast_limit)
    depth = "0"
    for k, split in enumerate(index.splits):
        side = split.selectExpr("cell AS _cell", f"1 AS _split{k}")
        located = located.withColumn("_cell", F.expr(key_at("_z", k, index.depths)))
        if index.split_bytes <= broadcast_limit:
            located = located.join(F.broadcast(side), "_cell", "left")
        else:
            located = salted_left_join(located, side, ["_cell"], rows_per_task, index.split_bytes)
        # A split cell lies in split cells of all depths before.
        depth += f" + coalesce(_split{k}, 0)"
    used = ["_z", *[f"_split{k}" for k in range(len(index.splits))]]
    located = located.withColumn("_cell", F.expr(key_at("_z", depth, index.depths))).drop(*used)
    # The same keys at every level, so the hot ones are looked for once.
    hot = None if small else hot_keys(located, ["_cell"], rows_per_task)
    winners = []
    for k, level in enumerate(index.levels):
        near, covering = f"_near{k}", f"_covering{k}"
        side = level.selectExpr("cell AS _cell", f"near AS {near}", f"covering AS {covering}")
        if small:
            located = located.join(F.broadcast(side), "_cell", "left")
        else:
            located = salted_left_join(located, side, ["_cell"], rows_per_task, index.bytes_estimate, hot)
        hit = f"CASE WHEN {near} IS NOT NULL THEN {_first_inside(near, lon, lat, bound)} END"
        if len(index.levels) == 1:
            # Every near zone precedes the covering one.
            winners.append(f"coalesce({hit}, {covering})")
        else:
            # Reduce at once: the arrays must not travel to the next join.
            located = located.withColumn(f"_win{k}", F.expr(f"least({hit}, {covering})"))
            located = located.drop(near, covering)
            winners.append(f"_win{k}")
    winner = winners[0] if len(winners) == 1 else f"least({', '.join(winners)})"
    label = f"""CASE WHEN {missing} THEN '{UNKNOWN}'
        ELSE coalesce(({winner}).name, '{OUTSIDE}') END"""
    return located.selectExpr(*[f"`{c}`" for c in pings.columns], f"{label} AS {out}")
