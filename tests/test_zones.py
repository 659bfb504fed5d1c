"""GeoJSON reading, the grid index and every way to join it."""

from __future__ import annotations

import json
import math
import random
import time
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from checking import plan_text
from pingzones.catalog import derived
from pingzones.operators import zone_index
from pingzones.operators.skew import hot_keys, salted_left_join
from pingzones.operators.zone_index import build_zone_index, default_cell
from pingzones.operators.zone_join import with_zone
from pingzones.sources.zones import empty_zones, read_zones, zones_from_features


@pytest.fixture(scope="module")
def geojson(tmp_path_factory):
    """The sample zones as a file."""
    features = []
    for properties, polygons in derived.SAMPLE_ZONES:
        kind, coordinates = derived.sample_geometry(polygons)
        features.append(
            {
                "type": "Feature",
                "properties": properties,
                "geometry": {"type": kind, "coordinates": coordinates},
            }
        )
    path = tmp_path_factory.mktemp("zones") / "sample.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    return str(path)


def points(spark, rows):
    return spark.createDataFrame(rows, "id int, latitude double, longitude double")


def labels(df):
    return [r["zona"] for r in df.orderBy("id").collect()]


def random_points(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.uniform(-17.96, -17.6), rnd.uniform(-63.4, -62.8)) for i in range(n)]
    return points(spark, rows)


def inside(polygon_edges, x, y):
    odd = False
    for ax, ay, bx, by in polygon_edges:
        side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if side == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return False
        if (ay > y) != (by > y) and (side > 0) == (by > ay):
            odd = not odd
    return odd


def brute_force(zones, pings):
    """Linear scan of all zones for every ping, in plain Python."""
    table = [(r["name"], [tuple(e) for e in r["edges"]]) for r in zones.orderBy("ord").collect()]
    out = []
    for r in pings.orderBy("id").collect():
        x, y = r["longitude"], r["latitude"]
        out.append(next((n for n, e in table if inside(e, x, y)), "Fuera_de_zona"))
    return out


def test_file_gives_same_zones_as_rows(spark, geojson):
    read = read_zones(spark, geojson).orderBy("ord").collect()
    assert read == derived.sample_zones(spark).orderBy("ord").collect()
    assert [r["name"] for r in read] == ["Norte", "Centro", "Sur", "Este", "ZONA_SIN_NOMBRE"]
    assert [len(r["edges"]) for r in read] == [4, 6, 8, 6, 4]


def test_folder_is_read_in_file_order(spark, tmp_path):
    for file, names in (("b.geojson", ["c", "d"]), ("a.geojson", ["a", "b"])):
        features = [
            {"properties": {"name": n}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}}
            for n in names
        ]
        (tmp_path / file).write_text(json.dumps({"features": features}))
    zones = read_zones(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r["ord"], r["name"]) for r in zones] == [
        (0, "a"),
        (1, "b"),
        (1 << 32, "c"),
        ((1 << 32) + 1, "d"),
    ]


def test_missing_or_unreadable_file_gives_no_zones(spark, tmp_path):
    with pytest.warns(UserWarning, match="none.geojson does not exist"):
        assert read_zones(spark, str(tmp_path / "none.geojson")).count() == 0
    broken = tmp_path / "broken.geojson"
    broken.write_text('{"type": "FeatureCollection", "features": [')
    with pytest.warns(UserWarning, match="broken.geojson"):
        assert read_zones(spark, str(broken)).count() == 0


def _feature(name, geometry):
    return {"type": "Feature", "properties": {"name": name}, "geometry": geometry}


SQUARE = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]


def test_one_broken_file_of_three_is_named(spark, tmp_path):
    for file in "ac":
        text = json.dumps({"features": [_feature(file, {"type": "Polygon", "coordinates": SQUARE})]})
        (tmp_path / f"{file}.geojson").write_text(text)
    (tmp_path / "b.geojson").write_text("{")
    with pytest.warns(UserWarning, match="b.geojson"):
        zones = read_zones(spark, str(tmp_path))
    assert [r["name"] for r in zones.orderBy("ord").collect()] == ["a", "c"]


@pytest.mark.parametrize(
    "geometry",
    [
        {"type": "Polygon", "coordinates": [[[0, 0], ["x", 0], [2, 2]]]},
        {"type": "Polygon", "coordinates": [[[0, 0], [1], [2, 2]]]},
        {"type": "MultiPolygon", "coordinates": 5},
        {"type": "Blob", "coordinates": SQUARE},
    ],
)
def test_bad_geometry_fails_unless_kept(spark, tmp_path, geometry):
    file = tmp_path / "zones.geojson"
    good = _feature("good", {"type": "Polygon", "coordinates": SQUARE})
    file.write_text(json.dumps({"features": [good, _feature("poor", geometry)]}))
    with pytest.raises(Exception, match="unreadable geometry of zone 1: poor"):
        read_zones(spark, str(file)).collect()
    kept = read_zones(spark, str(file), keep_bad=True).orderBy("ord").collect()
    assert [(r["name"], r["bad"], len(r["edges"])) for r in kept] == [("good", False, 4), ("poor", True, 0)]


def test_collections_and_geometries_without_area(spark, tmp_path):
    parts = [{"type": "Polygon", "coordinates": SQUARE}, {"type": "Point", "coordinates": [9, 9]},
             {"type": "MultiPolygon", "coordinates": [[[[4, 4], [6, 4], [6, 6], [4, 6]]]]}]
    file = tmp_path / "zones.geojson"
    features = [
        _feature("line", {"type": "LineString", "coordinates": [[0, 0], [5, 5]]}), _feature("none", None),
        _feature("all", {"type": "GeometryCollection", "geometries": parts}),
    ]
    file.write_text(json.dumps({"features": features}))
    index = build_zone_index(read_zones(spark, str(file)))
    got = labels(with_zone(points(spark, [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 3.0, 3.0)]), index))
    assert got == ["all", "all", "Fuera_de_zona"]


def test_text_coordinates(spark, geojson):
    index = build_zone_index(read_zones(spark, geojson))
    rows = [(1, "abc", "1"), (2, None, "1"), (3, " 89.5 ", "1e1"), (4, "1.5f", None), (5, "0", "")]
    df = spark.createDataFrame(rows, "id int, latitude string, longitude string")
    got = labels(with_zone(df, index))
    assert got == ["ERROR_COORDENADA", "Desconocida", "Fuera_de_zona", "Desconocida", "ERROR_COORDENADA"]
    empty = build_zone_index(empty_zones(spark))
    assert labels(with_zone(df, empty)) == got


def test_empty_names_fall_through(spark):
    rows = [
        (0, ("", "Zona A"), ("Polygon", "[[[0,0],[1,0],[1,1]]]")),
        (1, ("", ""), ("Polygon", "[[[0,0],[1,0],[1,1]]]")),
    ]
    zones = zones_from_features(spark.createDataFrame(rows, derived.FEATURE_DDL))
    assert [r["name"] for r in zones.orderBy("ord").collect()] == ["Zona A", "ZONA_SIN_NOMBRE"]


def test_named_points(spark):
    nan, inf = float("nan"), float("inf")
    pings = points(
        spark,
        [
            (0, -17.73, -63.2),  # in two zones, first wins
            (1, -17.75, -63.2),  # on the border of the first
            (2, -17.88, -63.08),  # in a hole
            (3, None, -63.2),
            (4, -17.73, None),
            (5, nan, -63.2),
            (6, inf, -inf),
            (7, -17.72, -62.85),  # second part of a zone
            (8, -17.675, -62.98),
            (9, -17.75, -63.3),  # a corner
        ],
    )
    got = labels(with_zone(pings, derived.sample_index(spark)))
    assert got == [
        "Norte",
        "Centro",
        "Fuera_de_zona",
        "Desconocida",
        "Desconocida",
        "Fuera_de_zona",
        "Fuera_de_zona",
        "Este",
        "ZONA_SIN_NOMBRE",
        "Fuera_de_zona",
    ]


def test_no_zones(spark):
    index = build_zone_index(empty_zones(spark))
    got = labels(with_zone(points(spark, [(0, -17.7, -63.2), (1, None, 1.0)]), index))
    assert got == ["Fuera_de_zona", "Desconocida"]


@pytest.mark.parametrize("cell", [None, 0.001, 0.02, 0.3, 5.0])
def test_cell_size_does_not_matter(spark, cell):
    zones, pings = derived.sample_zones(spark), random_points(spark)
    index = build_zone_index(zones, cell)
    assert labels(with_zone(pings, index)) == brute_force(zones, pings)
    index.release()


def random_zones(spark, rnd, n=30):
    """Star-shaped rings, some with a hole or a second part, on a coarse lattice."""

    def ring(cx, cy, r):
        spokes = [(k, rnd.uniform(0.3, 1.0) * r) for k in range(rnd.randint(3, 9))]
        turn = 2 * math.pi / len(spokes)
        corners = [(cx + q * math.cos(k * turn), cy + q * math.sin(k * turn)) for k, q in spokes]
        # Lattice corners make horizontal, vertical and shared edges likely.
        return [[round(x * 8) / 8, round(y * 8) / 8] for x, y in corners]

    rows = []
    for i in range(n):
        cx, cy, r = rnd.uniform(-5, 5), rnd.uniform(-5, 5), rnd.uniform(0.5, 3)
        polygon = [ring(cx, cy, r)] + ([ring(cx, cy, r / 4)] if i % 3 == 0 else [])
        parts = [polygon] + ([[ring(cx + 7, cy, r)]] if i % 5 == 0 else [])
        rows.append((i, (f"zone {i}", None), ("MultiPolygon", str(parts))))
    return zones_from_features(spark.createDataFrame(rows, derived.FEATURE_DDL))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_zones(spark, seed):
    """Corners, edge middles and random points against the linear scan."""
    rnd = random.Random(seed)
    zones = random_zones(spark, rnd).cache()
    places = [(rnd.uniform(-9, 15), rnd.uniform(-9, 9)) for _ in range(1500)]
    for r in zones.collect():
        for ax, ay, bx, by in r["edges"]:
            places += [(ax, ay), ((ax + bx) / 2, (ay + by) / 2)]
    pings = points(spark, [(i, y, x) for i, (x, y) in enumerate(places)])
    wanted = brute_force(zones, pings)
    assert len(set(wanted)) > 10
    for cell, max_edges in ((None, 50_000), (1.0, 20), (0.125, 50_000)):
        index = build_zone_index(zones, cell, max_edges)
        assert labels(with_zone(pings, index)) == wanted
        index.release()


def exactly_inside(polygon_edges, x, y):
    """``inside`` in the decimal digits that the coordinates are written with."""
    return inside([tuple(Fraction(repr(v)) for v in e) for e in polygon_edges], Fraction(repr(x)), Fraction(repr(y)))


@pytest.mark.parametrize("far", [0, 40, 170, 900, 5000])
def test_points_on_slanted_edges(spark, far):
    """On the edge, or next to it; beyond 1,000 the sides are those of doubles."""
    rnd = random.Random(far)
    corners = [(round(far + rnd.uniform(0, 1), 3), round(far / 2 + rnd.uniform(0, 1), 3)) for _ in range(3)]
    rows = [(0, ("slanted", None), ("Polygon", str([[list(c) for c in corners]])))]
    zones = zones_from_features(spark.createDataFrame(rows, derived.FEATURE_DDL))
    edges = [tuple(e) for e in zones.first()["edges"]]
    places = []
    for k in range(0, 1001, 4):
        (ax, ay), (bx, by) = (corners[k % 3], corners[(k + 1) % 3])
        x, y = (float(Fraction(str(a)) + (Fraction(str(b)) - Fraction(str(a))) * k / 1000) for a, b in ((ax, bx), (ay, by)))
        # Numbers near zero may have more digits than are told apart.
        beside = max(math.ulp(x), 2e-15)
        places += [(x, y), (x + beside, y), (x - beside, y)]
    places = [tuple(float(f"{v:.15f}") for v in place) for place in places]
    df = points(spark, [(i, y, x) for i, (x, y) in enumerate(places)])
    index = build_zone_index(zones)
    test = exactly_inside if far < 1000 else inside
    wanted = ["slanted" if test(edges, x, y) else "Fuera_de_zona" for x, y in places]
    assert labels(with_zone(df, index)) == wanted and len(set(wanted)) == 2
    index.release()


def test_z_order_keys(spark):
    """The key of a cell is that of each cell in it without its last bits."""
    cells = [(d, x, y) for d in range(4) for x in (-3, 0, 5) for y in (-64, 1, 7)]
    df = spark.createDataFrame(cells, "depth int, cx long, cy long")
    found = {}
    for d in range(4):
        for r in zone_index.with_key(df.filter(F.col("depth") == d), d, 3).collect():
            found[r["depth"], r["cx"], r["cy"]] = r["cell"]
    assert len(set(found.values())) == len(cells)
    middle = 1 << 27
    for (d, x, y), key in found.items():
        bits = [((x * 4 ** (3 - d) + middle) >> b & 1) | ((y * 4 ** (3 - d) + middle) >> b & 1) << 1 for b in range(28)]
        deepest = sum(v << 2 * b for b, v in enumerate(bits))
        assert key == deepest >> 4 * (3 - d) | 1 << (56 - 4 * (3 - d))


def test_plans_do_not_grow_with_the_depth(spark):
    """A map that is split again and again: as many jobs a depth, none planned on those before."""
    rows = []
    for i in range(400):
        r = 10.0 ** -(i % 5)
        x, y = (i * 7919 % 997) / 997 * r, (i * 104729 % 991) / 991 * r
        rows.append((i, (f"z{i}", None), ("Polygon", str([[[x, y], [x + r / 9, y], [x, y + r / 9]]]))))
    zones = zones_from_features(spark.createDataFrame(rows, derived.FEATURE_DDL)).cache()
    index = build_zone_index(zones, 1.0, target_edges=8)
    assert len(index.splits) >= 3
    for table in [*index.levels, *index.splits]:
        text = plan_text(table)
        assert "Scan parquet" in text and not any(step in text for step in ("Join", "Exchange", "Union"))
    pings = points(spark, [(i, (i * 31 % 101) / 101 * 10.0 ** -(i % 5), (i * 17 % 103) / 103 * 10.0 ** -(i % 5)) for i in range(1500)])
    wanted = brute_force(zones, pings)
    assert labels(with_zone(pings, index)) == wanted and len(set(wanted)) > 50
    index.release()


def test_crowded_map_builds_in_bounded_time(spark, sf):
    """Small zones by the thousand in one place, four large ones and a strip."""
    zones = zones_from_features(derived.crowded_features(spark, sf)).cache()
    assert zones.count() == 1505
    start = time.monotonic()
    index = build_zone_index(zones)
    assert time.monotonic() - start < 60
    pings = random_points(spark, 300).unionByName(
        points(spark, [(1000 + i, -17.74 + i % 20 / 1000, -63.21 + i // 20 / 1000) for i in range(400)])
    )
    assert labels(with_zone(pings, index)) == brute_force(zones, pings)
    index.release()


@pytest.mark.parametrize("options", [{}, {"broadcast_limit": 0}, {"broadcast_limit": 0, "rows_per_task": 50}])
@pytest.mark.parametrize("max_edges", [50_000, 8])
def test_many_zones_every_path(spark, sf, max_edges, options):
    """Broadcast and shuffled, with and without hot cells, one level and several."""
    zones = zones_from_features(derived.supplier_features(spark, sf))
    # A third of the pings share one place.
    pings = random_points(spark, 2000).unionByName(
        points(spark, [(10_000 + i, -17.8, -63.1) for i in range(1000)])
    )
    index = build_zone_index(zones, 0.02, max_edges)
    assert (len(index.levels) > 1) == (max_edges == 8)
    assert labels(with_zone(pings, index, **options)) == brute_force(zones, pings)
    index.release()


def test_covering_zone_needs_no_edges(spark):
    """Copies of one zone: only the first can win, so the others add nothing inside."""
    ring = "[[[0,0],[10,0],[10,10],[0,10]]]"
    rows = [(i, (f"copy {i}", None), ("Polygon", ring)) for i in range(50)]
    zones = zones_from_features(spark.createDataFrame(rows, derived.FEATURE_DDL))
    index = build_zone_index(zones, 1.0)
    inner = index.levels[0].filter("cx between 1 and 8 and cy between 1 and 8").collect()
    assert len(inner) == 64
    assert all(r["near"] is None and r["covering"]["ord"] == 0 for r in inner)
    pings = points(spark, [(0, 5.0, 5.0), (1, 0.5, 0.5), (2, 10.0, 5.0), (3, 10.5, 5.0)])
    assert labels(with_zone(pings, index)) == ["copy 0", "copy 0", "Fuera_de_zona", "Fuera_de_zona"]


def test_crowded_cells_keep_only_what_can_win(spark):
    """Zone 0 covers the middle cell, so the many borders behind it need no levels."""
    cover = "[[[0,0],[9,0],[9,9],[0,9]]]"
    rows = [(0, ("cover", None), ("Polygon", cover))]
    rows += [
        (i, (f"z{i}", None), ("Polygon", f"[[[4,4],[4.{i},4],[4.{i},5],[4,5]]]")) for i in range(1, 90)
    ]
    zones = zones_from_features(spark.createDataFrame(rows, derived.FEATURE_DDL))
    index = build_zone_index(zones, 3.0, max_edges=50)
    assert len(index.levels) == 1
    middle = index.levels[0].filter("cx = 1 AND cy = 1").first()
    assert middle["near"] is None and middle["covering"]["name"] == "cover"
    assert labels(with_zone(points(spark, [(0, 4.5, 4.05), (1, 9.5, 1.0)]), index)) == [
        "cover",
        "Fuera_de_zona",
    ]


def crowd(spark, rnd, n, copies=1):
    """Boxes of mixed sizes that lie behind each other, each drawn ``copies`` times, and a large one last."""
    boxes = [(rnd.uniform(0, 1), rnd.uniform(0, 1), rnd.uniform(0.05, 0.2)) for _ in range(n)]
    rows = [(i, x, y, x + r, y + r) for i, (x, y, r) in enumerate(boxes * copies)] + [(n * copies, -9.0, -9.0, 9.0, 9.0)]
    rows = [
        (i, (f"z{i}", None), ("Polygon", str([[[x0, y0], [x1, y0], [x1, y1], [x0, y1]]]))) for i, x0, y0, x1, y1 in rows
    ]
    return zones_from_features(spark.createDataFrame(rows, derived.FEATURE_DDL)).cache()


def entries_of(index):
    return sum(level.select(F.sum(F.coalesce(F.size("near"), F.lit(0)))).first()[0] or 0 for level in index.levels)


def test_zones_alike_in_a_cell_add_nothing(spark):
    """However often a map is drawn over itself, the index holds the first of each zone."""
    sizes = []
    for copies in (1, 8):
        zones = crowd(spark, random.Random(5), 40, copies)
        index = build_zone_index(zones, 0.5, target_edges=20)
        sizes.append((entries_of(index), sum(level.count() for level in index.levels)))
        pings = points(spark, [(i, (i * 31 % 101) / 80, (i * 17 % 103) / 80) for i in range(500)])
        assert labels(with_zone(pings, index)) == brute_force(zones, pings)
        index.release()
    assert sizes[0] == sizes[1]


def test_rounds_of_a_split_change_nothing(spark, monkeypatch):
    """First zones first, and those behind them not looked at: the cells are those of a split in one round."""
    zones = crowd(spark, random.Random(6), 300)
    pings = points(spark, [(i, (i * 31 % 101) / 80, (i * 17 % 103) / 80) for i in range(500)])
    asked = []
    children = zone_index._children

    def seen(entries, box, tasks, covering=None):
        asked.append(covering is not None)
        return children(entries, box, tasks, covering)

    monkeypatch.setattr(zone_index, "_children", seen)
    found = []
    for first in (zone_index.ROUND_ENTRIES, 50):
        monkeypatch.setattr(zone_index, "ROUND_ENTRIES", first)
        index = build_zone_index(zones, 0.5, target_edges=20)
        assert any(asked) == (first == 50)
        found.append([sorted(map(str, level.collect())) for level in index.levels])
        assert labels(with_zone(pings, index)) == brute_force(zones, pings)
        index.release()
    assert found[0] == found[1]


def test_many_zones_start_from_coarse_cells(spark, monkeypatch):
    """The first grid has few cells for each zone; the crowded ones alone are split."""
    monkeypatch.setattr(zone_index, "FIRST_ENTRIES", 100)
    zones = crowd(spark, random.Random(7), 200)
    index = build_zone_index(zones, target_edges=20)
    assert index.levels[0].filter("depth = 0").count() <= 2 * zone_index.FIRST_PER_ZONE * 201 and index.splits
    pings = points(spark, [(i, (i * 31 % 101) / 80, (i * 17 % 103) / 80) for i in range(500)])
    assert labels(with_zone(pings, index)) == brute_force(zones, pings)
    index.release()


def test_cell_size_follows_the_number_of_zones():
    assert default_cell(4, 4.0, 2.0) == 1 / 32
    assert default_cell(10_000_000, 10_000_000.0, 2.0) == 1 / 4
    assert default_cell(1, 0.0, 0.0) > 0


def test_index_rows_stay_bounded(spark):
    """Many zones whose borders share a cell are spread over levels."""
    rows = [
        (i, (f"z{i}", None), ("Polygon", f"[[[0,0],[{1 + i / 1000},0],[{1 + i / 1000},1],[0,1]]]"))
        for i in range(200)
    ]
    zones = zones_from_features(spark.createDataFrame(rows, derived.FEATURE_DDL))
    index = build_zone_index(zones, 5.0, max_edges=100)
    sizes = [
        level.select(F.max(F.expr("aggregate(near, 0, (a, z) -> a + size(z.edges))"))).first()[0]
        for level in index.levels
    ]
    assert len(sizes) == 8 and max(sizes) < 2 * 100
    pings = points(spark, [(0, 0.5, 0.5), (1, 0.5, 1.0005), (2, 0.5, 1.1005), (3, 0.5, 1.3)])
    assert labels(with_zone(pings, index)) == ["z0", "z1", "z101", "Fuera_de_zona"]


def test_hot_keys_are_found_and_split(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 7 WHEN id < 500 THEN NULL ELSE id END AS k", "id")
    assert [tuple(r) for r in hot_keys(df, ["k"], rows_per_task=100).collect()] == [(7, 4)]
    right = spark.range(600).selectExpr("id AS k", "id * 2 AS v")
    joined = salted_left_join(df, right, ["k"], rows_per_task=100)
    plain = df.join(right, "k", "left").select("k", "id", "v")
    assert sorted(map(tuple, joined.select("k", "id", "v").collect()), key=str) == sorted(
        map(tuple, plain.collect()), key=str
    )
