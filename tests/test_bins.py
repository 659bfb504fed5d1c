"""Label rules at and around every threshold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pingzones.functions import bins, parsing
from pingzones.schema import Thresholds

NAN = float("nan")
CASES = {
    "altitude": (
        bins.altitude_bin,
        "double",
        [(None, "Baja"), (400.0, "Baja"), (400.1, "Media"), (800.0, "Media"), (800.1, "Alta"), (NAN, "Alta")],
    ),
    "coverage": (
        bins.coverage_bin,
        "int",
        [(None, "Baja"), (-75, "Alta"), (-76, "Media"), (-95, "Media"), (-96, "Baja")],
    ),
    "speed": (
        bins.speed_bin,
        "double",
        [
            (None, "Detenido"),
            (0.0, "Detenido"),
            (-0.0, "Detenido"),
            (-1.0, "Lento"),
            (20.0, "Lento"),
            (20.1, "Normal"),
            (60.0, "Normal"),
            (60.1, "Rápido"),
            (NAN, "Rápido"),
        ],
    ),
    "battery": (
        bins.battery_bin,
        "int",
        [
            (None, "Baja"),
            (-1, "Crítica"),
            (10, "Crítica"),
            (11, "Baja"),
            (30, "Baja"),
            (31, "Media"),
            (70, "Media"),
            (71, "Alta"),
            (101, "Alta"),
        ],
    ),
    "operator": (
        bins.operator_class,
        "string",
        [
            (None, "OTRO"),
            ("", "OTRO"),
            (" tigo ", "TIGO"),
            ("tigo/entel", "ENTEL"),
            ("viva tigo", "TIGO"),
            ("Movil GSM BO", "VIVA"),
            ("Viva GSM", "VIVA"),
            ("Claro", "OTRO"),
        ],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_thresholds(spark, name):
    function, kind, cases = CASES[name]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], f"i int, v {kind}")
    labels = [r[0] for r in df.select("i", function("v").alias("l")).orderBy("i").select("l").collect()]
    assert labels == [label for _, label in cases]


def test_other_thresholds(spark):
    t = Thresholds(altitude_low_max=10, altitude_mid_max=20)
    df = spark.createDataFrame([(15.0,)], "v double")
    assert df.select(bins.altitude_bin("v", t)).first()[0] == "Media"


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("-17.8", -17.8),
        (" 1e3 ", 1000.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("1_000", 1000.0),
        ("-inf", float("-inf")),
        ("1.5f", None),
        ("0x10", None),
        ("", None),
        ("n/a", None),
        ("1__0", None),
    ],
)
def test_coordinate_text(spark, text, wanted):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(parsing.parse_coordinate(F.col("v"))).first()[0] == wanted


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_iso_times(spark, session_zone):
    cases = [
        ("2024-03-10T02:30:00.123456", "2024-03-10 02:30:00.123456"),
        ("2024-03-10 02:30:00", "2024-03-10 02:30:00"),
        ("2024-03-10T02:30:00Z", "2024-03-09 22:30:00"),
        ("2024-03-10T02:30:00.5+00:00", "2024-03-09 22:30:00.5"),
        ("2024-03-10T02:30:00-04:00", "2024-03-10 02:30:00"),
        ("2024-03-10", "2024-03-10 00:00:00"),
        ("soon", None),
        (None, None),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
        parsed = df.select("i", parsing.parse_iso_timestamp(F.col("t")).cast("string").alias("p"))
        got = [r["p"] for r in parsed.orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [w for _, w in cases]
