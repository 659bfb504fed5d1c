"""Category labels as SQL expressions (no Python at run time).

Each function takes the name of the input column and returns a column.  Spark
orders NaN above every number, so a NaN reading falls through every ``<=`` test
to the last label, which is the wanted outcome.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pingzones.schema import DEFAULT_THRESHOLDS, Thresholds


def altitude_bin(c: str, t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """Metres to Baja / Media / Alta; null counts as Baja."""
    return F.expr(
        f"""CASE WHEN {c} IS NULL OR {c} <= {t.altitude_low_max} THEN 'Baja'
                 WHEN {c} <= {t.altitude_mid_max} THEN 'Media'
                 ELSE 'Alta' END"""
    )


def coverage_bin(c: str, t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """Signal in dBm to Alta / Media / Baja; null fails both tests, so Baja."""
    return F.expr(
        f"""CASE WHEN {c} >= {t.coverage_high_min} THEN 'Alta'
                 WHEN {c} >= {t.coverage_mid_min} THEN 'Media'
                 ELSE 'Baja' END"""
    )


def speed_bin(c: str, t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """km/h to Detenido / Lento / Normal / Rápido; null counts as Detenido."""
    return F.expr(
        f"""CASE WHEN {c} IS NULL OR {c} = 0 THEN 'Detenido'
                 WHEN {c} <= {t.speed_slow_max} THEN 'Lento'
                 WHEN {c} <= {t.speed_normal_max} THEN 'Normal'
                 ELSE 'Rápido' END"""
    )


def battery_bin(c: str, t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """Percent to Crítica / Baja / Media / Alta; null counts as Baja."""
    return F.expr(
        f"""CASE WHEN {c} <= {t.battery_critical_max} THEN 'Crítica'
                 WHEN {c} IS NULL OR {c} <= {t.battery_low_max} THEN 'Baja'
                 WHEN {c} <= {t.battery_mid_max} THEN 'Media'
                 ELSE 'Alta' END"""
    )


# The class of an operator name is the first row whose text it contains.
OPERATOR_MARKS = [
    ("ENTEL", "ENTEL"),
    ("TIGO", "TIGO"),
    ("VIVA", "VIVA"),
    ("MOVIL GSM", "VIVA"),
]
OTHER_OPERATOR = "OTRO"


def operator_class(c: str) -> Column:
    """SIM operator text to ENTEL / TIGO / VIVA / OTRO; null counts as OTRO."""
    cases = " ".join(
        f"WHEN contains(upper({c}), '{mark}') THEN '{value}'" for mark, value in OPERATOR_MARKS
    )
    return F.expr(f"CASE {cases} ELSE '{OTHER_OPERATOR}' END")
