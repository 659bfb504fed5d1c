"""Adaptive grid over the zones, so that a ping looks only at zones near it.

A cell that a zone covers entirely needs no geometry: being in the cell is being
in the zone.  Only cells that a border runs through keep edges: those that meet
the cell, and a few upright ones that stand for everything further east.  Zones
after the first one that covers a cell entirely can never win there and are left
out.

A cell with more than ``target_edges`` edges is split into ``SIDE`` by ``SIDE``
cells of the next depth, again and again, unless that spreads its edges instead
of parting them (many borders along one line).  The cells of all depths make a
linear quadtree: one table whose key is the place of a cell on the Z curve, so
that the key of the cell around it is the same number without its last bits.
Each depth is written before the next one is made from it, so neither plans nor
lineage grow with the depth.  Cells that stay crowded above
``max_edges`` spread their zones over several levels, each joined in turn, so no
row grows with the number of zones that share a place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingzones.functions.geometry import cross, odd_crossings
from pingzones.operators.shared_folder import new_folder, release, written
from pingzones.operators.skew import BROADCAST_KEYS

CELLS_PER_ZONE = 1024
MIN_CELLS_PER_ZONE = 16
# Cells of the first grid, beyond which zones get fewer each.
MAX_ENTRIES = 100_000
# Zone and cell pairs of the first grid, in all or for each zone, beyond which it starts coarser.
FIRST_ENTRIES, FIRST_PER_ZONE = 400_000, 2
TARGET_EDGES = 100
MAX_EDGES_PER_ROW = 50_000
# A power of two, so that cells of different depths nest exactly.
SIDE = 4
MAX_DEPTH = 8
# A split may repeat the edges of a cell up to this often ...
MAX_SPREAD = 3
# ... and all splits together those of the first grid.
MAX_GROWTH = 4
# Smallest cell, as a part of the largest coordinate: cell numbers fit 28 bits.
FINEST = 1e-8
_CELL_BITS = 28
# Bits of a Z-order key that one depth adds: those of SIDE, for both axes.
_DEPTH_BITS = 2 * (SIDE.bit_length() - 1)
# Zone cells and edges that one task works on.
CELLS_PER_TASK, EDGES_PER_TASK = 5_000, 50_000
# Entries of the first round of a split, and how much more each further round takes.
ROUND_ENTRIES, ROUND_GROWTH = 50_000, 8
# Upper estimates of the bytes of one edge, zone entry and cell in a hash table.
_EDGE_BYTES, _ENTRY_BYTES, _CELL_BYTES = 48, 128, 96
WINNER_TYPE = "struct<ord:bigint,name:string>"
# A zone in a cell: the box is that of the whole zone, the edges are those that the cell needs.
_ENTRY = ("cx", "cy", "ord", "name", "x0", "x1", "y0", "y1", "covers", "edges")


@dataclass
class ZoneIndex:
    """Cells by level with the figures that decide how they are joined.

    ``depths`` is the deepest that a cell may be, which fixes the length of the
    keys; ``splits`` holds, for each depth, the cells that are split further.
    """

    cell: float
    bounds: tuple[float, float, float, float]  # x0, x1, y0, y1
    levels: list[DataFrame]
    bytes_estimate: int
    depths: int = 0
    splits: list[DataFrame] = field(default_factory=list)
    split_bytes: int = 0
    folder: str | None = None

    @property
    def is_empty(self) -> bool:
        return not self.levels

    @property
    def reach(self) -> float:
        """The largest coordinate."""
        return max(abs(b) for b in self.bounds)

    @property
    def extent(self) -> float:
        x0, x1, y0, y1 = self.bounds
        return max(x1 - x0, y1 - y0)

    def release(self) -> None:
        """Free the cells, cached and written."""
        for table in [*self.levels, *self.splits]:
            table.unpersist()
        if self.folder is not None:
            release(self.levels[0].sparkSession, self.folder)


def deepest(cell: float, reach: float) -> int:
    """How often a cell may be split before its numbers need more than ``_CELL_BITS`` bits."""
    depth = 0
    while depth < MAX_DEPTH and cell / SIDE ** (depth + 1) >= reach * FINEST:
        depth += 1
    return depth


def z_order(x: str, y: str) -> str:
    """The bits of two whole numbers from 0, those of ``y`` first, in turns.

    Binary digits read as digits to base 4 lie two bits apart.  Written with shifts
    and masks, each step would hold the one before twice.
    """
    spread = "CAST(conv(bin({0}), 4, 10) AS BIGINT)"
    return f"({spread.format(x)} | shiftleft({spread.format(y)}, 1))"


def deepest_cell(depths: int, gx: str, gy: str) -> str:
    """Z-order number, at the deepest level, of a point in units of the first cells."""
    scale, middle = f"{float(SIDE**depths)!r}D", 1 << (_CELL_BITS - 1)
    return z_order(*(f"floor({g} * {scale}) + {middle}" for g in (gx, gy)))


def key_at(z: str, depth: int | str, depths: int) -> str:
    """Key of the cell at ``depth`` around the deepest cell ``z``: its first bits after a one."""
    cut = f"CAST({_DEPTH_BITS} * ({depths} - ({depth})) AS INT)"
    return f"(shiftright({z}, {cut}) | shiftleft(1L, {2 * _CELL_BITS} - {cut}))"


def with_key(cells: DataFrame, depth: int, depths: int) -> DataFrame:
    """Cells (cx, cy) of one depth with their key in column ``cell``."""
    side, middle = SIDE ** (depths - depth), 1 << (_CELL_BITS - 1)
    z = z_order(*(f"{c} * {side} + {middle}" for c in ("cx", "cy")))
    return cells.withColumn("cell", F.expr(key_at(z, depth, depths)))


def default_cell(n: int, area: float, extent: float, spans: float = 0.0) -> float:
    """Cell side giving the average zone box many cells, fewer if there are many zones.

    ``area`` and ``spans`` are sums over the boxes, of their areas and of width
    plus height; the latter keeps narrow strips from having too many cells.
    """
    per_zone = max(MIN_CELLS_PER_ZONE, min(CELLS_PER_ZONE, MAX_ENTRIES // n))
    cell = max(math.sqrt(area / (n * per_zone)), spans / (n * per_zone))
    if cell > 0:
        return cell
    return extent / per_zone if extent > 0 else 0.01


@dataclass
class _Box:
    """Borders of cell (cx, cy) as SQL, a little wider than the cell.

    The slack covers rounding in the cell numbers and in the edge tests;
    ``reach`` is the largest coordinate.
    """

    cell: float
    reach: float

    def __post_init__(self):
        c, slack = f"{self.cell!r}D", f"{max(self.cell * 1e-6, self.reach * 1e-13)!r}D"
        self.west, self.east = f"(cx * {c} - {slack})", f"((cx + 1) * {c} + {slack})"
        self.south, self.north = f"(cy * {c} - {slack})", f"((cy + 1) * {c} + {slack})"
        self.middle = f"((cx + 0.5D) * {c})", f"((cy + 0.5D) * {c})"
        self.beside = f"greatest(e.ay, e.by) >= {self.south} AND least(e.ay, e.by) <= {self.north}"

    def cells_of_zone(self, axis: str) -> tuple[str, str]:
        """First and last cell of the zone's box along ``x`` or ``y``."""
        return f"floor({axis}0 / {self.cell!r}D)", f"floor({axis}1 / {self.cell!r}D)"

    def holds_zone(self) -> str:
        """Whether one cell holds the whole box of the zone."""
        return " AND ".join(f"{a} = {b}" for a, b in map(self.cells_of_zone, "xy"))

    def runs_through(self) -> str:
        # The corners where the cross product is least and greatest, by the direction of the edge.
        least = cross(
            "e", f"IF(e.by > e.ay, {self.east}, {self.west})", f"IF(e.bx > e.ax, {self.south}, {self.north})"
        )
        greatest = cross(
            "e", f"IF(e.by > e.ay, {self.west}, {self.east})", f"IF(e.bx > e.ax, {self.north}, {self.south})"
        )
        return f"""least(e.ax, e.bx) <= {self.east} AND greatest(e.ax, e.bx) >= {self.west}
            AND {self.beside} AND {least} <= 0 AND {greatest} >= 0"""


def _clipped(cells: DataFrame, box: _Box) -> DataFrame:
    """``cells`` with only the edges that a ray leaving the cell eastwards needs, and whether the zone is ``_whole``.

    A zone that lies in one cell as a whole needs all of its edges there.
    Of an edge entirely east of the cell only the heights of its ends matter: a
    ray at height y meets it if one end lies above y and the other does not.
    Heights that occur twice cancel out, as the inner corners of a border do, and
    heights above or below the cell are alike.  Upright edges between what is
    left give the same count for every y of the cell.
    """
    c = f"{box.cell!r}D"
    height = f"""CASE WHEN {{0}} > {box.north} THEN {box.north} + {c}
        WHEN {{0}} < {box.south} THEN {box.south} - {c} ELSE {{0}} END"""
    ends = f"flatten(transform(_far, e -> array({height.format('e.ay')}, {height.format('e.by')})))"
    uncancelled = f"""aggregate(array_sort({ends}), CAST(array() AS array<double>),
        (left, v) -> CASE WHEN try_element_at(left, -1) = v THEN slice(left, 1, size(left) - 1)
                          ELSE concat(left, array(v)) END)"""
    upright = """filter(transform(_heights, (v, i) ->
        named_struct('ax', _x, 'ay', v, 'bx', _x, 'by', get(_heights, i + 1))), (e, i) -> i % 2 = 0)"""
    cells = cells.withColumn("_whole", F.expr(box.holds_zone()))
    cells = _once(
        cells,
        _far=f"filter(IF(_whole, slice(edges, 1, 0), edges), e -> least(e.ax, e.bx) > {box.east} AND {box.beside})",
        _local=f"IF(_whole, edges, filter(edges, e -> least(e.ax, e.bx) <= {box.east}"
        f" AND greatest(e.ax, e.bx) >= {box.west} AND {box.beside}))",
    ).filter("size(_far) > 0 OR size(_local) > 0")
    cells = _once(cells, _heights=uncancelled, _x="array_max(transform(_far, e -> greatest(e.ax, e.bx)))")
    return _once(cells.drop("edges"), edges=f"concat(_local, {upright})").drop("_far", "_local", "_heights", "_x")


def _once(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns worked out once a row: later filters are not moved below a generator."""
    fields = ", ".join(f"'{name}', {value}" for name, value in columns.items())
    return df.selectExpr("*", f"inline(array(named_struct({fields})))")


def _touched(cells: DataFrame, box: _Box) -> DataFrame:
    """Of zone and cell pairs those that meet, as columns ``_ENTRY``."""
    met = _once(_clipped(cells, box), border=f"_whole OR exists(edges, e -> {box.runs_through()})")
    return (
        _once(met, covers=f"NOT border AND {odd_crossings('edges', *box.middle)}")
        .filter("border OR covers")
        .withColumn("edges", F.expr("IF(border, edges, NULL)"))
        .select(*_ENTRY)
    )


def _first_grid(zones: DataFrame, box: _Box, tasks: int) -> DataFrame:
    """Zones by the cells of depth 0.

    A zone file is one task's input and one zone may fill most of the grid, so
    the work is dealt out by zone and grid row.
    """
    def steps(axis):
        return f"explode(sequence({', '.join(box.cells_of_zone(axis))})) AS c{axis}"

    rows = zones.selectExpr("ord", "name", "x0", "x1", "y0", "y1", "edges", steps("y"))
    rows = rows.withColumn("edges", F.expr(f"filter(edges, e -> {box.beside})"))
    if tasks > 1:
        rows = rows.repartition(tasks, "ord", "cy")
    return _touched(rows.selectExpr("*", steps("x")), box)


def _children(entries: DataFrame, box: _Box, tasks: int, covering: DataFrame | None = None) -> DataFrame:
    """Zones by the cells of the next depth that their boxes meet; ``box`` is of that depth.

    Dealt out by zone as well, as one crowded cell may hold most of the work.
    Behind the zones known as ``covering`` nothing is worked out.
    """
    entries = entries.repartition(tasks, "ord", "cx", "cy")
    inner, rest = entries.filter("covers"), entries.filter("NOT covers").drop("covers")
    for axis in "xy":
        low, high = f"c{axis} * {SIDE}", f"c{axis} * {SIDE} + {SIDE - 1}"
        first, last = box.cells_of_zone(axis)
        others = [k for k in rest.columns if k != f"c{axis}"]
        inner = inner.selectExpr(*others, "covers", f"explode(sequence({low}, {high})) AS c{axis}")
        # Between numbers that may be far apart, an empty sequence would run downwards.
        within = f"filter(sequence({low}, {high}), i -> i BETWEEN {first} AND {last})"
        rest = rest.selectExpr(*others, f"explode({within}) AS c{axis}")
    if covering is not None:
        rest = _reachable(rest, covering)
    return inner.select(*_ENTRY).unionByName(_touched(rest, box))


def _reachable(entries: DataFrame, covering: DataFrame) -> DataFrame:
    """Entries up to the first zone that covers their cell."""
    return entries.join(covering, ["cx", "cy"], "left").filter("first IS NULL OR ord <= first").drop("first")


def _first_of_alike(entries: DataFrame) -> DataFrame:
    """Of zones with the same edges in a cell the first: the others hold the same points of it and never win there.

    No split parts borders that run along one line, as those of zones drawn twice or side by side.
    """
    alike = ["cx", "cy", "covers", "edges"]
    zone = F.struct(*[c for c in _ENTRY if c not in alike])
    return entries.groupBy(*alike).agg(F.min(zone).alias("zone")).select(*alike, "zone.*").select(*_ENTRY)


def _broadcast(keys: DataFrame) -> DataFrame:
    """A written table of cells, broadcast unless there are too many: the entries of a crowded cell need not meet."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _edges_of(edges: str) -> Column:
    return F.coalesce(F.size(edges), F.lit(0)).cast("bigint")


def _tasks(entries: int, edges: int) -> int:
    return max(1, math.ceil(max(entries / CELLS_PER_TASK, edges / EDGES_PER_TASK)))


class _Quadtree:
    """The written tables of one index while it is built, all under one folder."""

    def __init__(self, spark, cell: float, reach: float, target: int, depths: int):
        self.folder = new_folder(spark, "zone-index")
        self.spark, self.cell, self.reach, self.target, self.depths = spark, cell, reach, target, depths
        self.leaves: DataFrame | None = None
        self.splits: list[DataFrame] = []
        self.n_splits, self.most = 0, 0

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, f"{self.folder}/{name}")

    def _counts(self, entries: DataFrame, name: str) -> DataFrame:
        """(cx, cy, entries, edges) of each cell; only sizes are read."""
        return self._write(
            entries.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("entries"), F.sum("n_edges").alias("edges")), name
        )

    def _touching(self, rounds: list, depth: int) -> DataFrame:
        """Entries written, up to the first zone that covers their cell, of those alike only the first.

        Each of ``rounds`` makes entries, given the covering zones found by those before it.
        """
        met, covering = None, None
        for k, entries in enumerate(rounds):
            part = self._write(entries(covering), f"met-{depth}/{k}")
            met = part if met is None else met.unionByName(part)
            first = met.filter("covers").groupBy("cx", "cy").agg(F.min("ord").alias("first"))
            covering = _broadcast(self._write(first, f"covering-{depth}/{k}"))
        kept = _first_of_alike(_reachable(met, covering)).withColumn("n_edges", _edges_of("edges"))
        kept = self._write(kept, f"touching-{depth}")
        release(self.spark, f"{self.folder}/met-{depth}")
        return kept

    def _rounds(self, current: DataFrame, crowded: DataFrame, work, box: _Box, depth: int) -> list:
        """The work of splitting crowded cells: a few of the first zones of each cell, then more and more.

        Where zones lie behind each other, the first ones cover most of the cells, and
        the many behind them are left out before their edges are looked at.
        """
        keys = ["cx", "cy"]
        entries = current.join(_broadcast(crowded.select(*keys)), keys, "left_semi").drop("n_edges")
        # A border runs through about SIDE of the cells, and a zone smaller than them meets four at most.
        tasks = _tasks(SIDE * work[0], SIDE * work[1])
        shares, share = [], ROUND_ENTRIES / work[0]
        while share <= 1 / 2:
            shares.append(share)
            share *= ROUND_GROWTH
        if not shares:
            return [lambda covering: _children(entries, box, tasks)]
        ords = entries.groupBy(*keys).agg(F.percentile_approx("ord", shares, 100).alias("cuts"))
        cuts = _broadcast(self._write(ords, f"cuts-{depth}"))
        entries = entries.join(cuts, keys).withColumn("round", F.expr("size(filter(cuts, c -> ord > c))")).drop("cuts")

        def work_of(k, part):
            chosen = entries.filter(F.col("round") == k).drop("round")
            return lambda covering: _children(chosen, box, math.ceil(tasks * part), covering)

        ends = [0, *shares, 1]
        return [work_of(k, ends[k + 1] - ends[k]) for k in range(len(ends) - 1)]

    def _leaves(self, entries: DataFrame, depth: int) -> None:
        """Keep the entries of cells that are not split any further."""
        keyed = with_key(entries.drop("x0", "x1", "y0", "y1"), depth, self.depths).withColumn("depth", F.lit(depth))
        keyed.write.parquet(f"{self.folder}/leaves/at={depth}")
        most = self.spark.read.parquet(f"{self.folder}/leaves/at={depth}").groupBy("cell").agg(
            F.sum("n_edges").alias("edges")
        )
        self.most = max(self.most, most.agg(F.max("edges")).first()[0] or 0)

    def grow(self, first: DataFrame) -> None:
        """Split crowded cells where that parts their edges."""
        current = self._touching([lambda covering: first], 0)
        counts = self._counts(current, "counts-0")
        total = counts.agg(F.sum("edges")).first()[0] or 0
        budget, cell = MAX_GROWTH * total, self.cell
        for depth in range(self.depths):
            crowded = self._write(counts.filter(F.col("edges") > self.target), f"crowded-{depth}")
            work = crowded.agg(F.sum("entries"), F.sum("edges")).first()
            if not work[0]:
                break
            cell /= SIDE
            tried = self._touching(self._rounds(current, crowded, work, _Box(cell, self.reach), depth), depth + 1)
            inner = self._counts(tried, f"tried-{depth + 1}")
            up = {a: F.floor(F.col(a) / SIDE) for a in ("cx", "cy")}
            after = inner.groupBy(up["cx"].alias("cx"), up["cy"].alias("cy")).agg(F.sum("edges").alias("after"))
            chosen = self._write(
                after.join(crowded, ["cx", "cy"])
                .filter(F.col("after") <= MAX_SPREAD * F.col("edges"))
                .select("cx", "cy", (F.col("after") - F.col("edges")).alias("more")),
                f"chosen-{depth}",
            )
            s = chosen.agg(F.count(F.lit(1)), F.sum("more")).first()
            if not s[0] or total + s[1] > budget:
                break
            total, self.n_splits = total + s[1], self.n_splits + s[0]
            chosen = _broadcast(chosen.select("cx", "cy"))
            self.splits.append(self._write(with_key(chosen, depth, self.depths).select("cell"), f"splits/at={depth}"))
            self._leaves(current.join(chosen, ["cx", "cy"], "left_anti"), depth)
            parents = chosen.withColumnsRenamed({"cx": "_px", "cy": "_py"})
            is_child = (up["cx"] == F.col("_px")) & (up["cy"] == F.col("_py"))
            current, counts = (t.join(parents, is_child, "left_semi") for t in (tried, inner))
        self._leaves(current, len(self.splits))

    def levels(self, max_edges: int) -> tuple[list[DataFrame], int]:
        """One table of cells for each level, and the bytes they take."""
        entries = self.spark.read.parquet(f"{self.folder}/leaves").drop("at")
        n_levels = max(1, math.ceil(self.most / max_edges))
        spread = F.when(~F.col("covers"), F.pmod(F.xxhash64("ord"), F.lit(n_levels))).otherwise(0).cast("int")
        cells = self._write(_cells(entries.withColumn("level", spread)), "cells")
        m = cells.agg(
            F.count(F.lit(1)).alias("cells"),
            F.sum(F.coalesce(F.size("near"), F.lit(0))).alias("entries"),
            F.sum(_edge_count("near")).alias("edges"),
        ).first()
        size = m["cells"] * _CELL_BYTES + (m["entries"] or 0) * _ENTRY_BYTES + (m["edges"] or 0) * _EDGE_BYTES
        return [cells.filter(F.col("level") == k).drop("level").persist() for k in range(n_levels)], size

    def tidy(self) -> None:
        """Delete what only building needed."""
        for depth in range(len(self.splits) + 2):
            for name in ("covering", "cuts", "touching", "counts", "tried", "crowded", "chosen"):
                release(self.spark, f"{self.folder}/{name}-{depth}")
        release(self.spark, f"{self.folder}/leaves")


def build_zone_index(
    zones: DataFrame,
    cell: float | None = None,
    max_edges: int = MAX_EDGES_PER_ROW,
    target_edges: int = TARGET_EDGES,
) -> ZoneIndex:
    """Index a zone table.  Runs a few small jobs over the zones; the cells stay written and cached."""
    spark = zones.sparkSession
    folder = new_folder(spark, "zones")
    # Filtered once written: a filter before would work out the edges a second time.
    usable = written(zones, folder).filter(F.size("edges") > 0)
    width, height = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    s = usable.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(width * height).alias("area"),
        F.sum(width + height).alias("spans"),
        F.sum(_edges_of("edges")).alias("edges"),
        F.min("x0").alias("x0"),
        F.max("x1").alias("x1"),
        F.min("y0").alias("y0"),
        F.max("y1").alias("y1"),
    ).first()
    if s["n"] == 0:
        release(spark, folder)
        return ZoneIndex(cell or 0.01, (0.0, 0.0, 0.0, 0.0), [], 0)
    bounds = (s["x0"], s["x1"], s["y0"], s["y1"])
    reach = max(abs(b) for b in bounds)
    extent = max(s["x1"] - s["x0"], s["y1"] - s["y0"])
    start = max(cell or default_cell(s["n"], s["area"], extent, s["spans"]), reach * FINEST)
    # An index of many zones starts from coarser cells: only the crowded ones are split to the size of their zones.
    sizes = [start * SIDE**k for k in range(1 if cell else MAX_DEPTH + 1)]
    pairs = usable.agg(*[F.sum((width / c + 1) * (height / c + 1)) for c in sizes]).first()
    most = max(FIRST_ENTRIES, FIRST_PER_ZONE * s["n"])
    cell, n_cells = next((p for p in zip(sizes, pairs) if p[1] <= most), (sizes[-1], pairs[-1]))

    tree = _Quadtree(spark, cell, reach, target_edges, deepest(cell, reach))
    tree.grow(_first_grid(usable, _Box(cell, reach), _tasks(n_cells, s["edges"])))
    levels, size = tree.levels(max_edges)
    tree.tidy()
    release(spark, folder)
    return ZoneIndex(
        cell, bounds, levels, size, tree.depths, [t.persist() for t in tree.splits], tree.n_splits * _CELL_BYTES,
        tree.folder,
    )


def _cells(entries: DataFrame) -> DataFrame:
    """One row per level and cell: the first zone covering it and the border zones before that one."""
    grouped = entries.groupBy("level", "cell").agg(
        *[F.first(c).alias(c) for c in ("depth", "cx", "cy")],
        F.min(F.when(F.col("covers"), F.struct("ord", "name"))).alias("covering"),
        F.array_sort(
            F.collect_list(F.when(~F.col("covers"), F.struct("ord", "name", "edges")))
        ).alias("near"),
    )
    return grouped.withColumn("near", F.when(F.size("near") > 0, F.col("near")))


def _edge_count(near: str) -> Column:
    per_zone = F.transform(near, lambda z: F.size(z["edges"]).cast("bigint"))
    return F.coalesce(F.aggregate(per_zone, F.lit(0).cast("bigint"), lambda a, n: a + n), F.lit(0))
