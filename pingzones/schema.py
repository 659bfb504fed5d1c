"""Schemas, column orders, labels and thresholds shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PING_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("device_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("altitude", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("battery", T.IntegerType()),
        T.StructField("signal", T.IntegerType()),
        T.StructField("sim_operator", T.StringType()),
        T.StructField("network_type", T.StringType()),
        # Wall-clock time without a zone: no session setting can shift it.
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("device_id", T.StringType()),
    ]
)
PING_COLUMNS = PING_SCHEMA.fieldNames()

OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("latitud", T.DoubleType()),
        T.StructField("longitud", T.DoubleType()),
        T.StructField("zona", T.StringType()),
        T.StructField("altitud", T.DoubleType()),
        T.StructField("altitud_categoria", T.StringType()),
        T.StructField("cobertura", T.IntegerType()),
        T.StructField("cobertura_categoria", T.StringType()),
        T.StructField("velocidad", T.DoubleType()),
        T.StructField("velocidad_categoria", T.StringType()),
        T.StructField("bateria", T.IntegerType()),
        T.StructField("bateria_categoria", T.StringType()),
        T.StructField("compania", T.StringType()),
        T.StructField("fecha_hora", T.TimestampNTZType()),
    ]
)
OUTPUT_COLUMNS = OUTPUT_SCHEMA.fieldNames()

# Output columns that carry a source value unchanged.
PASS_THROUGH = {
    "id": "id",
    "latitud": "latitude",
    "longitud": "longitude",
    "altitud": "altitude",
    "cobertura": "signal",
    "velocidad": "speed",
    "bateria": "battery",
    "fecha_hora": "timestamp",
}
LABEL_COLUMNS = [c for c in OUTPUT_COLUMNS if c not in PASS_THROUGH]

# Labels that downstream consumers compare by text.
UNKNOWN = "Desconocida"
OUTSIDE = "Fuera_de_zona"
BAD_COORDINATE = "ERROR_COORDENADA"
UNNAMED_ZONE = "ZONA_SIN_NOMBRE"


@dataclass(frozen=True)
class Thresholds:
    """Bin edges: metres, dBm, km/h and percent."""

    altitude_low_max: int = 400
    altitude_mid_max: int = 800
    coverage_mid_min: int = -95
    coverage_high_min: int = -75
    speed_slow_max: int = 20
    speed_normal_max: int = 60
    battery_critical_max: int = 10
    battery_low_max: int = 30
    battery_mid_max: int = 70


DEFAULT_THRESHOLDS = Thresholds()
