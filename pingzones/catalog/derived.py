"""Inputs derived by Spark from the given tables.

The tables hold no coordinates, so pings come from ``events`` and a large zone
table from ``supplier``.  Each derivation is a list of SQL expressions that
Spark and the checking database read alike.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingzones.operators.zone_index import ZoneIndex, build_zone_index
from pingzones.sources.zones import zones_from_features

PING_EXPRESSIONS = {
    "id": "CAST(event_id AS INT)",
    "device_name": "concat('DEVICE_', CAST(user_id AS STRING))",
    "latitude": """CASE WHEN event_id % 23 = 0 THEN NULL
        WHEN event_id % 29 = 1 THEN CAST('-17.73' AS DOUBLE)
        WHEN event_id % 31 = 2 THEN CAST('-17.75' AS DOUBLE)
        WHEN event_id % 37 = 3 THEN CAST('-17.88' AS DOUBLE)
        ELSE CAST('-17.94' AS DOUBLE)
             + CAST((event_id * 7919) % 31000 AS DOUBLE) / CAST(100000 AS DOUBLE) END""",
    "longitude": """CASE WHEN event_id % 41 = 0 THEN NULL
        WHEN event_id % 29 = 1 THEN CAST('-63.2' AS DOUBLE)
        WHEN event_id % 31 = 2 THEN CAST('-63.2' AS DOUBLE)
        WHEN event_id % 37 = 3 THEN CAST('-63.08' AS DOUBLE)
        ELSE CAST('-63.34' AS DOUBLE)
             + CAST((event_id * 104729) % 54000 AS DOUBLE) / CAST(100000 AS DOUBLE) END""",
    "altitude": "CASE WHEN event_id % 11 = 0 THEN NULL"
    " ELSE CAST((event_id * 13) % 1201 AS DOUBLE) END",
    "speed": "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 5 = 0 THEN CAST(0 AS DOUBLE)"
    " ELSE CAST((event_id * 17) % 91 AS DOUBLE) END",
    "battery": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST((event_id * 19) % 101 AS INT) END",
    "signal": "CASE WHEN event_id % 19 = 0 THEN NULL"
    " ELSE CAST(-40 - (event_id * 23) % 81 AS INT) END",
    "sim_operator": "CASE event_id % 8 WHEN 0 THEN 'Entel' WHEN 1 THEN ' tigo '"
    " WHEN 2 THEN 'Viva GSM' WHEN 3 THEN 'Movil GSM BO' WHEN 4 THEN 'Claro' WHEN 5 THEN ''"
    " WHEN 6 THEN NULL ELSE 'tigo/entel' END",
    "network_type": "CASE event_id % 3 WHEN 0 THEN '4G' WHEN 1 THEN '3G' ELSE 'LTE' END",
    "timestamp": "ts",
    "device_id": "concat('ID_', CAST(user_id AS STRING))",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        *[f"{e} AS `{name}`" for name, e in PING_EXPRESSIONS.items()]
    )


# Zones with an overlap, a concave ring, a hole, two parts and
# missing names.  (properties, list of polygons, each a list of lon-lat rings)
SAMPLE_ZONES = [
    (
        {"name": "Norte"},
        [[[(-63.30, -17.75), (-63.10, -17.75), (-63.10, -17.65), (-63.30, -17.65)]]],
    ),
    (
        {"name": "Centro"},
        [
            [
                [
                    (-63.25, -17.85),
                    (-63.05, -17.85),
                    (-63.05, -17.80),
                    (-63.15, -17.80),
                    (-63.15, -17.72),
                    (-63.25, -17.72),
                ]
            ]
        ],
    ),
    (
        {"name": "Sur"},
        [
            [
                [(-63.20, -17.93), (-62.95, -17.93), (-62.95, -17.83), (-63.20, -17.83)],
                [(-63.12, -17.90), (-63.05, -17.90), (-63.05, -17.86), (-63.12, -17.86)],
            ]
        ],
    ),
    (
        {"zona": "Este"},
        [
            [[(-63.00, -17.80), (-62.90, -17.80), (-62.95, -17.70)]],
            [[(-62.88, -17.75), (-62.82, -17.75), (-62.85, -17.68)]],
        ],
    ),
    (
        {},
        [[[(-62.99, -17.69), (-62.97, -17.69), (-62.97, -17.66), (-62.99, -17.66)]]],
    ),
]


def sample_geometry(polygons: list) -> tuple[str, list]:
    """GeoJSON type and coordinates, with closed rings and a third ordinate of 0."""
    closed = [[[[x, y, 0] for x, y in [*ring, ring[0]]] for ring in p] for p in polygons]
    return ("Polygon", closed[0]) if len(closed) == 1 else ("MultiPolygon", closed)


FEATURE_DDL = (
    "ord bigint, properties struct<name: string, zona: string>,"
    " geometry struct<type: string, coordinates: string>"
)


def sample_zones(spark: SparkSession) -> DataFrame:
    rows = []
    for i, (properties, polygons) in enumerate(SAMPLE_ZONES):
        kind, coordinates = sample_geometry(polygons)
        rows.append((i, (properties.get("name"), properties.get("zona")), (kind, str(coordinates))))
    return zones_from_features(spark.createDataFrame(rows, FEATURE_DDL))


# A point a ping on, or a billionth of a degree beside, one of the slanted edges of
# the sample zones: (start, step) of longitude and latitude, a thousand steps an edge.
SLANTED_EDGES = (
    (("-63.00", "0.00005"), ("-17.80", "0.0001")),
    (("-62.90", "-0.00005"), ("-17.80", "0.0001")),
    (("-62.88", "0.00003"), ("-17.75", "0.00007")),
    (("-62.82", "-0.00003"), ("-17.75", "0.00007")),
)


def _along(axis: int, beside: str) -> str:
    cases = " ".join(
        f"WHEN {k} THEN CAST('{edge[axis][0]}' AS DECIMAL(12, 9))"
        f" + CAST(event_id % 1001 AS DECIMAL(4, 0)) * CAST('{edge[axis][1]}' AS DECIMAL(12, 9))"
        for k, edge in enumerate(SLANTED_EDGES)
    )
    return f"CAST(CAST(CASE event_id % {len(SLANTED_EDGES)} {cases} END + {beside} AS DECIMAL(12, 9)) AS DOUBLE)"


SLANTED_POINTS = {
    "id": "CAST(event_id AS INT)",
    "longitude": _along(0, "CAST((event_id % 3) - 1 AS DECIMAL(1, 0)) * CAST('0.000000001' AS DECIMAL(12, 9))"),
    "latitude": _along(1, "CAST('0' AS DECIMAL(12, 9))"),
}


# One zone a supplier: a rectangle or a triangle, of one of seven sizes.
SUPPLIER_X = (
    "CAST('-63.34' AS DOUBLE) + CAST((s_suppkey * 104729) % 54000 AS DOUBLE) / CAST(100000 AS DOUBLE)"
)
SUPPLIER_Y = (
    "CAST('-17.94' AS DOUBLE) + CAST((s_suppkey * 7919) % 31000 AS DOUBLE) / CAST(100000 AS DOUBLE)"
)
SUPPLIER_R = "CAST(1 + s_suppkey % 7 AS DOUBLE) / CAST(200 AS DOUBLE)"
ZONES_PER_FILE = 500


def supplier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON features, one a supplier, as columns of ``FEATURE_DDL``."""
    s = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "s_name", f"{SUPPLIER_X} AS x", f"{SUPPLIER_Y} AS y", f"{SUPPLIER_R} AS r"
    )
    x, y, r = F.col("x"), F.col("y"), F.col("r")

    def vertex(a, b):
        return F.array(a, b, F.lit(0.0))

    first = vertex(x - r, y - r)
    box = F.array(first, vertex(x + r, y - r), vertex(x + r, y + r), vertex(x - r, y + r), first)
    triangle = F.array(first, vertex(x + r, y - r), vertex(x, y + r), first)
    rings = F.array(F.when(F.col("s_suppkey") % 2 == 0, box).otherwise(triangle))
    return s.select(
        F.col("s_suppkey").alias("ord"),
        F.struct(F.col("s_name").alias("name"), F.lit(None).cast("string").alias("zona")).alias(
            "properties"
        ),
        F.struct(
            F.lit("Polygon").alias("type"), F.to_json(rings).alias("coordinates")
        ).alias("geometry"),
    )


# A crowded map as boxes (ord, name, x0, y0, x1, y1): a small one a customer, all
# within two hundredths of a degree; behind them four large ones, and between a
# strip across the map, from the five regions.
CROWDED_BOXES = """
    SELECT c_custkey AS ord, c_name AS name, x - r AS x0, y - r AS y0, x + r AS x1, y + r AS y1
    FROM (SELECT c_custkey, c_name,
                 CAST('-63.21' AS DOUBLE) + CAST((c_custkey * 104729) % 2000 AS DOUBLE) / CAST(100000 AS DOUBLE) AS x,
                 CAST('-17.74' AS DOUBLE) + CAST((c_custkey * 7919) % 2000 AS DOUBLE) / CAST(100000 AS DOUBLE) AS y,
                 CAST(1 + c_custkey % 7 AS DOUBLE) / CAST(20000 AS DOUBLE) AS r
          FROM customer) AS small
    UNION ALL
    SELECT 1000000000000 + r_regionkey, r_name, x, y, x + CAST('0.27' AS DOUBLE), y + CAST('0.17' AS DOUBLE)
    FROM (SELECT r_regionkey, r_name,
                 CAST('-63.34' AS DOUBLE) + CAST(r_regionkey % 2 AS DOUBLE) / CAST(4 AS DOUBLE) AS x,
                 CAST('-17.94' AS DOUBLE) + CAST((r_regionkey - r_regionkey % 2) AS DOUBLE) / CAST(13 AS DOUBLE) AS y
          FROM region WHERE r_regionkey < 4) AS large
    UNION ALL
    SELECT 500000000000, r_name, CAST('-63.4' AS DOUBLE), CAST('-17.7303' AS DOUBLE),
           CAST('-62.8' AS DOUBLE), CAST('-17.7297' AS DOUBLE)
    FROM region WHERE r_regionkey = 4"""


BOXES_PER_TASK = 10_000


def crowded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON features of the crowded map, as columns of ``FEATURE_DDL``."""
    tables = {name: table(spark, sf_dir, name) for name in ("customer", "region")}
    boxes = spark.sql(CROWDED_BOXES.replace("FROM customer", "FROM {customer}").replace("FROM region", "FROM {region}"), **tables)
    # A customer file of a few megabytes holds more zones than one task should parse.
    tasks = math.ceil(tables["customer"].count() / BOXES_PER_TASK)
    if tasks > 1:
        boxes = boxes.repartition(tasks, "ord")
    corner = lambda a, b: F.array(F.col(a), F.col(b))
    first = corner("x0", "y0")
    ring = F.array(first, corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), first)
    return boxes.select(
        "ord",
        F.struct("name", F.lit(None).cast("string").alias("zona")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.to_json(F.array(ring)).alias("coordinates")).alias("geometry"),
    )


def write_supplier_geojson(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Feature collections of at most ZONES_PER_FILE zones, one file each, in key order."""
    f = supplier_features(spark, sf_dir)
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json("properties"),
        F.lit(',"geometry":{"type":"Polygon","coordinates":'),
        F.col("geometry.coordinates"),
        F.lit("}}"),
    )
    part = F.lpad(F.floor(F.col("ord") / ZONES_PER_FILE).cast("string"), 12, "0")
    (
        f.select(part.alias("part"), F.struct("ord", feature.alias("text")).alias("f"))
        .groupBy("part")
        .agg(F.array_sort(F.collect_list("f")).alias("features"))
        .select(
            "part",
            F.concat(
                F.lit('{"type":"FeatureCollection","features":['),
                F.array_join("features.text", ","),
                F.lit("]}"),
            ).alias("value"),
        )
        .write.partitionBy("part")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


_indexes: dict[tuple, ZoneIndex] = {}


def sample_index(spark: SparkSession) -> ZoneIndex:
    """Index of the sample zones, built once a session."""
    key = (spark.sparkContext.applicationId, "sample")
    if key not in _indexes:
        _indexes[key] = build_zone_index(sample_zones(spark))
    return _indexes[key]


def supplier_index(spark: SparkSession, sf_dir: str) -> ZoneIndex:
    key = (spark.sparkContext.applicationId, "supplier", sf_dir)
    if key not in _indexes:
        _indexes[key] = build_zone_index(zones_from_features(supplier_features(spark, sf_dir)))
    return _indexes[key]
