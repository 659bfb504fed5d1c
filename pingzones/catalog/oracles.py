"""Checking SQL for the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from pingzones.catalog.derived import (
    CROWDED_BOXES,
    PING_EXPRESSIONS,
    SAMPLE_ZONES,
    SLANTED_POINTS,
    SUPPLIER_R,
    SUPPLIER_X,
    SUPPLIER_Y,
    ZONES_PER_FILE,
)
from pingzones.catalog.queries import LOOKBACK, MARK, PAGE_KEY, SLOW_NETWORK
from pingzones.operators.paging import PAGE_SIZE
from pingzones.schema import OUTPUT_COLUMNS, PASS_THROUGH, PING_COLUMNS

_PINGS = "pings AS (SELECT " + ", ".join(
    f'{e} AS "{name}"' for name, e in PING_EXPRESSIONS.items()
) + " FROM events)"
_ALL_PING_COLUMNS = ", ".join(f'"{c}"' for c in PING_COLUMNS)
_MARK = f"TIMESTAMP '{MARK}'"

BIN_SQL = {
    "altitud_categoria": "CASE WHEN altitude IS NULL OR altitude <= 400 THEN 'Baja'"
    " WHEN altitude <= 800 THEN 'Media' ELSE 'Alta' END",
    "cobertura_categoria": "CASE WHEN signal IS NULL THEN 'Baja' WHEN signal >= -75 THEN 'Alta'"
    " WHEN signal >= -95 THEN 'Media' ELSE 'Baja' END",
    "velocidad_categoria": "CASE WHEN speed IS NULL OR speed = 0 THEN 'Detenido'"
    " WHEN speed <= 20 THEN 'Lento' WHEN speed <= 60 THEN 'Normal' ELSE 'Rápido' END",
    "bateria_categoria": "CASE WHEN battery IS NULL THEN 'Baja' WHEN battery <= 10 THEN 'Crítica'"
    " WHEN battery <= 30 THEN 'Baja' WHEN battery <= 70 THEN 'Media' ELSE 'Alta' END",
    "compania": "CASE WHEN sim_operator IS NULL THEN 'OTRO'"
    " WHEN upper(trim(sim_operator)) LIKE '%ENTEL%' THEN 'ENTEL'"
    " WHEN upper(trim(sim_operator)) LIKE '%TIGO%' THEN 'TIGO'"
    " WHEN upper(trim(sim_operator)) LIKE '%VIVA%' THEN 'VIVA'"
    " WHEN upper(trim(sim_operator)) LIKE '%MOVIL GSM%' THEN 'VIVA' ELSE 'OTRO' END",
}


def _double(v: float) -> str:
    return f"CAST('{v}' AS DOUBLE)"


def _sample_edges() -> str:
    rows = []
    for i, (properties, polygons) in enumerate(SAMPLE_ZONES):
        name = properties.get("name") or properties.get("zona") or "ZONA_SIN_NOMBRE"
        for ring in (ring for p in polygons for ring in p):
            for a, b in zip(ring, [*ring[1:], ring[0]]):
                ends = ", ".join(_double(v) for v in (*a, *b))
                rows.append(f"({i}, '{name}', {ends})")
    return f"edges(ord, name, ax, ay, bx, by_) AS (VALUES {', '.join(rows)})"


_SAMPLE_EDGES = _sample_edges()

# The same four corners as the features that Spark derives from supplier.
_SUPPLIER_EDGES = f"""shape AS (
    SELECT s_suppkey AS ord, s_name AS name, x - r AS x0, y - r AS y0, x + r AS x1, y + r AS y1, x
    FROM (SELECT s_suppkey, s_name, {SUPPLIER_X} AS x, {SUPPLIER_Y} AS y, {SUPPLIER_R} AS r
          FROM supplier)),
edges AS (
    SELECT ord, name, x0 AS ax, y0 AS ay, x1 AS bx, y0 AS by_ FROM shape
    UNION ALL SELECT ord, name, x1, y0, x1, y1 FROM shape WHERE ord % 2 = 0
    UNION ALL SELECT ord, name, x1, y1, x0, y1 FROM shape WHERE ord % 2 = 0
    UNION ALL SELECT ord, name, x0, y1, x0, y0 FROM shape WHERE ord % 2 = 0
    UNION ALL SELECT ord, name, x1, y0, x, y1 FROM shape WHERE ord % 2 = 1
    UNION ALL SELECT ord, name, x, y1, x0, y0 FROM shape WHERE ord % 2 = 1)"""

_CROWDED_EDGES = f"""boxes AS ({CROWDED_BOXES}),
edges AS (
    SELECT ord, name, x0 AS ax, y0 AS ay, x1 AS bx, y0 AS by_ FROM boxes
    UNION ALL SELECT ord, name, x1, y0, x1, y1 FROM boxes
    UNION ALL SELECT ord, name, x1, y1, x0, y1 FROM boxes
    UNION ALL SELECT ord, name, x0, y1, x0, y0 FROM boxes)"""

# Tests every ping against every edge: an odd number of edges to the right of
# the ping and none under it.  The side is told in decimal numbers, by the digits
# that the coordinates are written with.


def _exact(difference: str) -> str:
    a, b = difference.split(" - ")
    return f"(CAST(CAST({a} AS VARCHAR) AS DECIMAL(18, 15)) - CAST(CAST({b} AS VARCHAR) AS DECIMAL(18, 15)))"


_LEFT = f"{_exact('bx - ax')} * {_exact('latitude - ay')}"
_RIGHT = f"{_exact('by_ - ay')} * {_exact('longitude - ax')}"
# Of a ping and an edge whose heights or boxes do not meet the side does not matter.
_ZONED = f"""met AS (
    SELECT id, ord, name,
           (ay > latitude) <> (by_ > latitude) AND greatest(ax, bx) >= longitude AS ahead,
           longitude BETWEEN least(ax, bx) AND greatest(ax, bx)
               AND latitude BETWEEN least(ay, by_) AND greatest(ay, by_) AS beside,
           ax, ay, bx, by_, longitude, latitude
    FROM pings, edges),
hits AS (
    SELECT id, ord, name FROM met WHERE ahead OR beside
    GROUP BY id, ord, name
    HAVING count(*) FILTER (WHERE CASE WHEN ahead THEN ({_LEFT} > {_RIGHT}) = (by_ > ay) END) % 2 = 1
       AND count(*) FILTER (WHERE CASE WHEN beside THEN {_LEFT} = {_RIGHT} END) = 0),
winners AS (SELECT id, arg_min(name, ord) AS name FROM hits GROUP BY id),
zoned AS (
    SELECT pings.*, CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'Desconocida'
                         ELSE coalesce(winners.name, 'Fuera_de_zona') END AS zona
    FROM pings LEFT JOIN winners USING (id))"""


def _output(zona: str = "zona") -> str:
    parts = []
    for c in OUTPUT_COLUMNS:
        if c == "zona":
            parts.append(f"{zona} AS zona")
        elif c in PASS_THROUGH:
            parts.append(f'"{PASS_THROUGH[c]}" AS {c}')
        else:
            parts.append(f"{BIN_SQL[c]} AS {c}")
    return ", ".join(parts)


_ENRICHED = f"WITH {_PINGS}, {_SAMPLE_EDGES}, {_ZONED} SELECT {_output()} FROM zoned"
_SUPPLIER_ZONED = f"WITH {_PINGS}, {_SUPPLIER_EDGES}, {_ZONED} SELECT id, zona FROM zoned"
_NO_ZONE = (
    "CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'Desconocida' ELSE 'Fuera_de_zona' END"
)
_ALL_PINGS = f"WITH {_PINGS} SELECT * FROM pings"
_SLOW = f"network_type = '{SLOW_NETWORK}'"


def _snapped(c: str) -> str:
    return f"CAST(floor({c} * 20 + CAST('0.5' AS DOUBLE)) AS DOUBLE) / CAST(20 AS DOUBLE)"


def _bin(column: str, out: str) -> str:
    return f"WITH {_PINGS} SELECT id, {column}, {BIN_SQL[out]} AS {out} FROM pings"


ORACLES: dict[str, str] = {
    "enriched_pings": _ENRICHED,
    "output_shape": f"WITH {_PINGS} SELECT {_output(_NO_ZONE)} FROM pings",
    "fill_labels": f"""WITH {_PINGS}
        SELECT id, coalesce(c_mktsegment, 'Desconocida') AS zona,
               coalesce(nullif(sim_operator, ''), 'Desconocida') AS compania
        FROM pings LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0)
          ON device_id = concat('ID_', CAST(c_custkey AS VARCHAR))""",
    "category_rollup": f"SELECT zona, compania, count(*) AS pings FROM ({_ENRICHED})"
    " GROUP BY zona, compania",
    "zone_of_ping": f"WITH {_PINGS}, {_SAMPLE_EDGES}, {_ZONED} SELECT id, zona FROM zoned",
    "zone_boundary": f"""WITH raw AS (SELECT * FROM ({_ALL_PINGS})),
        pings AS (SELECT id, {_snapped('latitude')} AS latitude,
                         {_snapped('longitude')} AS longitude FROM raw),
        {_SAMPLE_EDGES}, {_ZONED} SELECT id, latitude, longitude, zona FROM zoned""",
    "zone_slanted_edges": "WITH pings AS (SELECT "
    + ", ".join(f"{e} AS {c}" for c, e in SLANTED_POINTS.items())
    + f" FROM events), {_SAMPLE_EDGES}, {_ZONED} SELECT id, longitude, latitude, zona FROM zoned",
    "zone_empty": f"WITH {_PINGS} SELECT id, {_NO_ZONE} AS zona FROM pings",
    "zone_table": f"""WITH {_SUPPLIER_EDGES},
        numbered AS (
            SELECT s_suppkey,
                   dense_rank() OVER (ORDER BY s_suppkey // {ZONES_PER_FILE}) - 1 AS file_rank,
                   row_number() OVER (PARTITION BY s_suppkey // {ZONES_PER_FILE}
                                      ORDER BY s_suppkey) - 1 AS pos
            FROM supplier)
        SELECT CAST(file_rank * 4294967296 + pos AS BIGINT) AS ord, any_value(name) AS name,
               CAST(count(*) AS INT) AS n_edges,
               min(ax) AS x0, max(ax) AS x1, min(ay) AS y0, max(ay) AS y1
        FROM edges JOIN numbered ON ord = s_suppkey GROUP BY file_rank, pos""",
    "zone_of_ping_many_zones": _SUPPLIER_ZONED,
    "zone_of_ping_shuffled": _SUPPLIER_ZONED,
    "altitude_bin": _bin("altitude", "altitud_categoria"),
    "coverage_bin": _bin("signal", "cobertura_categoria"),
    "speed_bin": _bin("speed", "velocidad_categoria"),
    "battery_bin": _bin("battery", "bateria_categoria"),
    "operator_class": _bin("sim_operator", "compania"),
    "coordinate_parse": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS coordinate,
               CASE WHEN event_type = 'error' AND props IS NOT NULL THEN 'ERROR_COORDENADA'
                    ELSE 'ok' END AS status FROM events""",
    # "Z" names an instant, four hours ahead of the wall clock kept.
    "parse_timestamps": """
        SELECT event_id, CASE event_type WHEN 'view' THEN ts - INTERVAL 4 HOUR
                                         WHEN 'error' THEN NULL ELSE ts END AS fecha_hora
        FROM events""",
    "format_timestamps": """
        SELECT CAST(event_id AS INT) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS blank_text,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso_text FROM events""",
    "full_scan": _ALL_PINGS,
    "incremental_scan": f'{_ALL_PINGS} WHERE "timestamp" > {_MARK}',
    "page_scan": _ALL_PINGS,
    # A blank CSV field is a null.
    "csv_scan": f"WITH {_PINGS} SELECT * REPLACE (nullif(sim_operator, '') AS sim_operator) FROM pings",
    "offset_page": f'{_ALL_PINGS} ORDER BY "timestamp", id LIMIT {PAGE_SIZE} OFFSET {PAGE_SIZE}',
    "offset_pages_of_equal_keys": f"""WITH {_PINGS}
        SELECT * REPLACE (id % 10 AS id, date_trunc('hour', "timestamp") AS "timestamp") FROM pings""",
    "keyset_page": f"""{_ALL_PINGS} WHERE ("timestamp", id) > (TIMESTAMP '{PAGE_KEY[0]}', {PAGE_KEY[1]})
        ORDER BY "timestamp", id LIMIT {PAGE_SIZE}""",
    "keyset_full_pull": f"""WITH {_PINGS} SELECT * FROM (
        SELECT * REPLACE (CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS "timestamp")
        FROM pings) WHERE "timestamp" > {_MARK}""",
    "keyset_pull_resumed": f"""WITH {_PINGS}
        SELECT * REPLACE (CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS "timestamp") FROM pings""",
    "union_pages": _ALL_PINGS,
    "drop_missing_id": f"{_ALL_PINGS} WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "target_high_water_mark": "SELECT max(ts) AS max_ts FROM events",
    "next_id": "SELECT CAST(coalesce(max(event_id), 0) + 1 AS BIGINT) AS next_id FROM events",
    "append_with_ids": f"""WITH {_PINGS},
        indexed AS (SELECT *, row_number() OVER (ORDER BY "timestamp", id) - 1 AS i FROM pings),
        fresh AS (
            SELECT *, concat('again-', lpad(CAST(i AS VARCHAR), 12, '0')) AS new_name,
                   "timestamp" + INTERVAL 1 MINUTE AS new_time FROM indexed),
        numbered AS (
            SELECT *, (SELECT max(id) FROM pings)
                      + row_number() OVER (ORDER BY new_time, new_name) AS new_id FROM fresh)
        SELECT {_ALL_PING_COLUMNS} FROM pings UNION ALL
        SELECT CAST(new_id AS INT), new_name, latitude, longitude, altitude, speed, battery, signal,
               sim_operator, network_type, new_time, concat('again-', CAST(new_id AS VARCHAR))
        FROM numbered""",
    "append_roundtrip": _ENRICHED,
    "seed_roundtrip": f"WITH {_PINGS} SELECT * REPLACE (upper(network_type) AS device_name) FROM pings",
    "incremental_cycle": _ENRICHED,
    "late_rows_dropped": f"SELECT * FROM ({_ENRICHED}) WHERE id NOT IN ("
    f"SELECT id FROM ({_ALL_PINGS}) WHERE {_SLOW} AND \"timestamp\" <= ("
    f"SELECT max(\"timestamp\") FROM ({_ALL_PINGS}) WHERE NOT {_SLOW} AND \"timestamp\" <= {_MARK}))",
    "late_rows_recovered": f"""WITH source AS ({_ALL_PINGS}),
        mark AS (SELECT max("timestamp") AS t FROM source
                 WHERE NOT {_SLOW} AND "timestamp" <= {_MARK})
        SELECT * FROM ({_ENRICHED}) WHERE id NOT IN (
            SELECT id FROM source, mark
            WHERE {_SLOW} AND "timestamp" <= t - INTERVAL {LOOKBACK.days} DAY)""",
    "run_metrics": "SELECT count(*) AS extracted, count(*) AS loaded FROM events",
    "stream_cycle": _ENRICHED,
    "zone_of_ping_crowded": f"WITH {_PINGS}, {_CROWDED_EDGES}, {_ZONED} SELECT id, zona FROM zoned",
    "logged_append": _ENRICHED,
    "logged_cycle": _ENRICHED,
    "logged_mark": f"""SELECT count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
        FROM events GROUP BY ts < {_MARK}""",
}
ORACLES["logged_replace"] = ORACLES["seed_roundtrip"]
ORACLES["late_rows_stream"] = ORACLES["late_rows_recovered"]
