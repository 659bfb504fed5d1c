"""Zone table from GeoJSON feature collections.

Columns: ``ord bigint, name string, x0, x1, y0, y1 double, edges array<edge>``.
``ord`` is the position in the file; where zones overlap the lowest one wins.
"""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pingzones.functions.geometry import EDGE_TYPE, ring_edges
from pingzones.schema import UNNAMED_ZONE

# Polygon and MultiPolygon nest to different depths, so coordinates are read as
# text first and parsed by geometry type.
_COLLECTION = (
    "features array<struct<"
    "properties: struct<name: string, zona: string>,"
    "geometry: struct<type: string, coordinates: string, geometries: string>>>"
)
_RING_LIST = "array<array<array<double>>>"
ZONE_DDL = (
    f"ord bigint, name string, x0 double, x1 double, y0 double, y1 double, edges array<{EDGE_TYPE}>"
)
_FILE_STRIDE = 1 << 32
# Unreadable files that a warning names.
NAMED_FILES = 20


def empty_zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ZONE_DDL)


def zone_name(name: Column, zona: Column) -> Column:
    """First non-empty of the two properties, else the fixed fallback."""
    return F.coalesce(F.nullif(name, F.lit("")), F.nullif(zona, F.lit("")), F.lit(UNNAMED_ZONE))


# Geometries without an area cannot contain a ping.
_NO_AREA = "('Point', 'MultiPoint', 'LineString', 'MultiLineString')"


def _rings(kind: str, coordinates: str) -> str:
    """Rings of one geometry; null if they cannot be read."""
    return f"""CASE
        WHEN {kind} = 'Polygon' THEN from_json({coordinates}, '{_RING_LIST}')
        WHEN {kind} = 'MultiPolygon' THEN flatten(from_json({coordinates}, 'array<{_RING_LIST}>'))
        WHEN {kind} IN {_NO_AREA} THEN CAST(array() AS {_RING_LIST})
        END"""


def zones_from_features(features: DataFrame, keep_bad: bool = False) -> DataFrame:
    """Zone table from columns ``ord, properties, geometry``.

    A geometry that cannot be read fails the job.  With ``keep_bad`` it becomes a
    zone without edges, and a column ``bad`` tells such zones.  A feature without
    a geometry, or with one that has no area, is a zone that contains nothing.
    """
    if "geometries" not in features.select("geometry.*").columns:
        with_parts = F.struct("geometry.*", F.lit(None).cast("string").alias("geometries"))
        features = features.withColumn("geometry", F.when(F.col("geometry").isNotNull(), with_parts))
    parts = "from_json(geometry.geometries, 'array<struct<type:string,coordinates:string>>')"
    rings = f"""CASE WHEN geometry.type = 'GeometryCollection'
        THEN flatten(transform({parts}, g -> {_rings('g.type', 'g.coordinates')}))
        ELSE {_rings('geometry.type', 'geometry.coordinates')} END"""
    none = f"CAST(array() AS array<{EDGE_TYPE}>)"
    # A ring, a vertex or a number that could not be read is null.
    bad = """geometry.type IS NOT NULL AND (_rings IS NULL OR exists(_rings, ring -> ring IS NULL
        OR exists(ring, v -> v IS NULL OR size(v) < 2 OR v[0] IS NULL OR v[1] IS NULL)))"""
    name = zone_name(F.col("properties.name"), F.col("properties.zona"))
    read = features.withColumn("_rings", F.expr(rings)).withColumns({"_bad": F.expr(bad), "_name": name})
    edges = f"CASE WHEN _bad THEN {none} ELSE coalesce({ring_edges('_rings')}, {none}) END"
    if not keep_bad:
        edges = f"""CASE WHEN _bad THEN raise_error(concat('unreadable geometry of zone ', ord, ': ', _name))
            ELSE {edges} END"""
    with_edges = read.select(
        F.col("ord").cast("bigint").alias("ord"), F.col("_name").alias("name"),
        F.expr(f"CAST({edges} AS array<{EDGE_TYPE}>)").alias("edges"),
        *([F.col("_bad").alias("bad")] if keep_bad else []),
    )
    # Rings are closed, so the first ends of the edges are all the vertices.
    return with_edges.select(
        "ord",
        "name",
        F.array_min("edges.ax").alias("x0"),
        F.array_max("edges.ax").alias("x1"),
        F.array_min("edges.ay").alias("y0"),
        F.array_max("edges.ay").alias("y1"),
        "edges",
        *(["bad"] if keep_bad else []),
    )


def read_zones(spark: SparkSession, path: str, keep_bad: bool = False) -> DataFrame:
    """Zones of one GeoJSON file, or of a folder of them in file-name order.

    A missing path gives no zones and an unreadable file none of its own, with a
    warning that names it; located pings are then outside.  For ``keep_bad`` see
    ``zones_from_features``.
    """
    try:
        documents = spark.read.schema(_COLLECTION).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no zones: {path} does not exist", stacklevel=2)
        return empty_zones(spark)
    located = documents.select("features", F.col("_metadata.file_path").alias("file"))
    unread = located.filter("features IS NULL").select("file").limit(NAMED_FILES).collect()
    if unread:
        warnings.warn(f"no zones in unreadable files: {', '.join(r['file'] for r in unread)}", stacklevel=2)
    # File names only, one a document, so this ungrouped window stays small.
    ranks = located.select("file").distinct()
    rank = F.row_number().over(Window.orderBy("file")) - 1
    located = located.join(ranks.select("file", rank.cast("bigint").alias("file_rank")), "file")
    features = located.select("file_rank", F.posexplode("features").alias("pos", "feature")).select(
        (F.col("file_rank") * _FILE_STRIDE + F.col("pos")).alias("ord"), "feature.*"
    )
    return zones_from_features(features, keep_bad)
