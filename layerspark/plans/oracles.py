"""The registered queries as ANSI SQL over the same tables, for an independent check."""

from __future__ import annotations

import math

from layerspark.functions import geo
from layerspark.operators import style
from layerspark.plans import queries as q
from layerspark.sources import generate as gen
from layerspark.spec import to_json


def D(x) -> str:  # noqa: N802
    return f"CAST({x} AS DOUBLE)"


def spread(key: str, factor: int, modulus: int, start: float) -> str:
    return f"({D(start)} + {D(0.3)} * {D(f'(({key}) * {factor}) % {modulus}')} / {D(float(modulus))})"


def lon_of(key: str, factor: int = 7919) -> str:
    return spread(key, factor, 10007, -122.6)


def lat_of(key: str, factor: int = 6271) -> str:
    return spread(key, factor, 10009, 37.6)


def haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    dlat = f"sin(radians(({lat2}) - ({lat1})) / 2)"
    dlon = f"sin(radians(({lon2}) - ({lon1})) / 2)"
    a = f"{dlat} * {dlat} + cos(radians({lat1})) * cos(radians({lat2})) * {dlon} * {dlon}"
    return f"({D(2 * geo.EARTH_RADIUS_M)} * asin(sqrt(least({a}, {D(1.0)}))))"


PLACES = f"""places AS (
  SELECT o_orderkey AS feature_id, {lon_of('o_orderkey')} AS lon, {lat_of('o_orderkey')} AS lat,
         CAST(20 + o_orderkey % 180 AS FLOAT) AS radius, o_totalprice AS value,
         o_orderpriority AS category, o_orderstatus AS name
  FROM orders)"""
NULLS = f"""{PLACES}, places_nulls AS (
  SELECT feature_id, CASE WHEN feature_id % 97 <> 0 THEN lon END AS lon,
         CASE WHEN feature_id % 97 <> 0 THEN lat END AS lat, radius,
         CASE WHEN feature_id % 89 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value, category, name
  FROM places)"""
COLOURS = f"""{PLACES}, coloured AS (
  SELECT *, CAST(feature_id * 31 % 256 AS INTEGER) AS r, CAST(feature_id * 57 % 256 AS INTEGER) AS g,
         CAST(feature_id * 91 % 256 AS INTEGER) AS b FROM places)"""
MOVED = f"""{PLACES}, moved AS (
  SELECT feature_id, CASE WHEN feature_id % 50 = 0 THEN lon + {D(0.001)} ELSE lon END AS lon, lat, radius,
         value, category, name FROM places)"""
STEP = gen.GRID_SPAN / 64
GRID = f"""grid AS (
  SELECT p_partkey AS cell_id, {D(-122.6)} + (p_partkey % 64) * {D(STEP)} AS west,
         {D(37.6)} + (p_partkey // 64) * {D(STEP)} AS south FROM part)"""
VERTICES = f"""vertices AS (
  SELECT user_id, event_id, epoch_us(ts) AS t, {lon_of('event_id')} AS lon, {lat_of('event_id')} AS lat,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events)"""
ARCS = f"""arcs AS (
  SELECT l_orderkey, l_linenumber, {lon_of('l_orderkey')} AS src_lon, {lat_of('l_orderkey')} AS src_lat,
         {lon_of('l_suppkey', 5557)} AS dst_lon, {lat_of('l_suppkey', 4241)} AS dst_lat FROM lineitem)"""
INTERACTIONS = f"""interactions AS (
  SELECT event_id, ts, epoch_us(ts) AS t, user_id AS session,
         CASE event_id % 3 WHEN 0 THEN 'clicked' WHEN 1 THEN 'hovered' ELSE 'view_state' END AS kind,
         'layer-' || (event_id % 3) || '-' || (event_id % 4) AS sub_layer_id,
         CASE WHEN event_id % 41 <> 0 THEN event_id % 100 END AS batch_index,
         {lon_of('event_id', 5557)} AS lon, {lat_of('event_id', 4241)} AS lat,
         {lon_of('event_id')} AS longitude, {lat_of('event_id')} AS latitude,
         CAST(event_id % 20 AS DOUBLE) AS zoom, CAST(event_id % 360 AS DOUBLE) AS bearing
  FROM events)"""
PARTS = f"""{PLACES}, parts AS (
  SELECT 'layer-' || (feature_id % 3) AS layer_id, (feature_id // 3) % 3 AS batch_id, feature_id, name,
         category, value FROM places),
sub_counts AS (SELECT layer_id, batch_id, count(*) AS num_rows FROM parts GROUP BY ALL),
sub_layers AS (
  SELECT *, layer_id || '-' || batch_id AS sub_layer_id,
         CAST(coalesce(sum(num_rows) OVER (PARTITION BY layer_id ORDER BY batch_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS row_offset
  FROM sub_counts),
indexed AS (
  SELECT *, row_number() OVER (PARTITION BY layer_id ORDER BY batch_id, feature_id) - 1 AS row_index FROM parts),
{INTERACTIONS}"""
PICKED = f"""{PARTS}, resolved AS (
  SELECT i.*, coalesce(s.layer_id, i.sub_layer_id) AS layer_id,
         coalesce(s.row_offset, 0) + coalesce(i.batch_index, -1) AS row_index,
         i.batch_index IS NULL AS no_index, s.layer_id IS NOT NULL AS known_layer
  FROM interactions i LEFT JOIN sub_layers s USING (sub_layer_id) WHERE i.kind <> 'view_state')"""


def h3_cell() -> str:
    base = int("8928308280fffff", 16) & ~(0b111111111 << 18)
    digits = " | ".join(
        f"(((p_partkey // {div}) % 7) << {bits})" for div, bits in ((1, 24), (7, 21), (49, 18))
    )
    return f"(CAST({base} AS BIGINT) | {digits})"


H3 = f"h3 AS (SELECT p_partkey AS feature_id, {h3_cell()} AS cell, p_retailprice AS value FROM part)"


def h3_parent(cell: str, res: int) -> str:
    kept, fill = ~(15 << 52), (1 << (3 * (15 - res))) - 1
    return f"((({cell}) & CAST({kept} AS BIGINT)) | CAST({(res << 52) | fill} AS BIGINT))"


def geohash_code(lon: str, lat: str, length: int) -> str:
    bits = 5 * length
    nx, ny = (bits + 1) // 2, bits // 2
    x = f"least(greatest(CAST(floor((({lon}) + {D(180.0)}) / {D(360.0)} * {D(2.0 ** nx)}) AS BIGINT), 0), {2 ** nx - 1})"
    y = f"least(greatest(CAST(floor((({lat}) + {D(90.0)}) / {D(180.0)} * {D(2.0 ** ny)}) AS BIGINT), 0), {2 ** ny - 1})"
    parts = []
    for place in range(bits):
        source, width = (x, nx) if place % 2 == 0 else (y, ny)
        parts.append(f"((({source} >> {width - 1 - place // 2}) & 1) << {bits - 1 - place})")
    return f"(CASE WHEN ({lon}) IS NOT NULL AND ({lat}) IS NOT NULL THEN {' | '.join(parts)} END)"


def geohash_text(code: str, length: int) -> str:
    return " || ".join(
        f"substr('{geo.GEOHASH_ALPHABET}', CAST(({code} >> {5 * (length - 1 - i)}) & 31 AS INTEGER) + 1, 1)"
        for i in range(length)
    )


def rollup(source: str, cell: str, value: str = "value") -> str:
    score = f"({value} / {D(float(q.SCORE_PRIME))})"
    stats = {
        "mean": f"avg({score})",
        "std": f"stddev_pop({score})",
        "min": f"min({score})",
        "max": f"max({score})",
        "p10": f"quantile_cont({score}, 0.1)",
        "p90": f"quantile_cont({score}, 0.9)",
    }
    columns = ", ".join(f"round({text}, 8) AS {name}" for name, text in stats.items())
    return f"""SELECT {cell} AS cell, count(*) AS count, {columns}
    FROM {source} WHERE {cell} IS NOT NULL AND {value} IS NOT NULL AND NOT isnan({value}) GROUP BY 1"""


def uniform(key: str, seed: int, stream: int) -> str:
    digits = f"substr(md5('{seed}/{stream}/' || CAST({key} AS VARCHAR)), 1, 13)"
    return f"(CAST(CAST('0x' || {digits} AS BIGINT) AS DOUBLE) / CAST(4503599627370496 AS DOUBLE))"


def box_where(lon: str, lat: str, box) -> str:
    west, south, east, north = box
    return f"{lat} BETWEEN {D(south)} AND {D(north)} AND {lon} BETWEEN {D(west)} AND {D(east)}"


def near(lon: str, lat: str) -> str:
    return f"{haversine(lon, lat, D(q.BRUSH_CENTER[0]), D(q.BRUSH_CENTER[1]))} <= {D(q.BRUSH_RADIUS_M)}"


def next_pass(source: str, keys: str, micros: int) -> str:
    """Greedy leading-edge throttle by following, per key, the next time that can pass."""
    return f"""WITH RECURSIVE {source},
    firsts AS (SELECT {keys}, t, min(event_id) AS event_id FROM considered GROUP BY ALL),
    hops AS (SELECT *, min(t) OVER (PARTITION BY {keys} ORDER BY t
             RANGE BETWEEN {micros} FOLLOWING AND UNBOUNDED FOLLOWING) AS next_t,
             row_number() OVER (PARTITION BY {keys} ORDER BY t) AS place FROM firsts),
    passed AS (SELECT {keys}, t, next_t, event_id FROM hops WHERE place = 1
      UNION ALL SELECT {', '.join('h.' + k.strip() for k in keys.split(','))}, h.t, h.next_t, h.event_id
      FROM passed p JOIN hops h ON {' AND '.join(f'h.{k.strip()} = p.{k.strip()}' for k in keys.split(','))}
        AND h.t = p.next_t)"""


def md5_sum(text: str) -> str:
    return f"CAST(sum(CAST(CAST('0x' || substr(md5(feature_id || '|' || coalesce({text}, '~')), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR)"


def scaled(column: str) -> str:
    return f"CAST(CAST(round({column} * {D(10_000_000)}) AS BIGINT) AS VARCHAR)"


def escaped(text: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#39;")):
        text = f"replace({text}, '{char}', '{entity}')"
    return text


def number_text(column: str) -> str:
    return (
        f"CASE WHEN {column} = floor({column}) THEN CAST(CAST({column} AS BIGINT) AS VARCHAR) "
        f"ELSE CAST({column} AS VARCHAR) END"
    )


def div(name: str, text: str) -> str:
    return f"'<div>{name}: ' || {escaped(f'coalesce({text}, chr(0))')} || '</div>'".replace("chr(0)", "''")


def picked_pair(prev: str, curr: str, columns: list[str]) -> str:
    differs = ", ".join(f"CASE WHEN p.{c} IS DISTINCT FROM c.{c} THEN '{c}' END" for c in columns)
    return differs


def ring_corner(corner: int) -> tuple[str, str]:
    side = D(gen.GRID_FILL * STEP)
    west = f"({D(-122.6)} + (p_partkey % 64) * {D(STEP)})"
    south = f"({D(37.6)} + (p_partkey // 64) * {D(STEP)})"
    dx, dy = ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))[corner]
    return (f"{west} + {side}" if dx else west), (f"{south} + {side}" if dy else south)


def registry() -> dict[str, str]:
    box = geo.view_box(q.VIEW["longitude"], q.VIEW["latitude"], q.VIEW["zoom"])
    parts = q.PART_VERTICES - 1
    ramp = f"""{NULLS}, edges AS (
      SELECT quantile_cont(value, {style.RAMP_LOW}) AS low, quantile_cont(value, {style.RAMP_HIGH}) AS high
      FROM places_nulls WHERE NOT isnan(value))"""
    share = f"least(greatest((value - low) / greatest(high - low, {D(1e-9)}), {D(0.0)}), {D(1.0)})"
    coloured = f"""CASE WHEN isnan(value) THEN 128 ELSE CAST(floor({share} * 255) AS INTEGER) END AS r,
      CASE WHEN isnan(value) THEN 128 ELSE 80 END AS g,
      CASE WHEN isnan(value) THEN 128 ELSE CAST(floor(({D(1.0)} - {share}) * 255) AS INTEGER) END AS b"""
    bounds = f"WITH {ramp} SELECT round(low, 4) AS low, round(high, 4) AS high FROM edges"
    rolled5 = f"WITH {NULLS}, coded AS (SELECT {geohash_code('lon', 'lat', 5)} AS code, value FROM places_nulls), named AS (SELECT {geohash_text('code', 5)} AS gh, value FROM coded WHERE code IS NOT NULL) {rollup('named', 'gh')}"
    level6 = f"WITH {PLACES}, coded AS (SELECT {geohash_code('lon', 'lat', 6)} AS code, value FROM places), named AS (SELECT {geohash_text('code', 6)} AS gh, value FROM coded), rolled AS ({rollup('named', 'gh')}) SELECT cell AS cell_id, mean AS dem_mean, std AS dem_std, min AS dem_min, max AS dem_max, p10 AS dem_p10, p90 AS dem_p90 FROM rolled"
    radius = q.RADIUS_M
    band = math.degrees(radius / geo.EARTH_RADIUS_M) * 1.001
    nearest = f"""WITH {NULLS}, {INTERACTIONS}, pairs AS (
      SELECT i.event_id AS point_id, p.feature_id, {haversine('i.lon', 'i.lat', 'p.lon', 'p.lat')} AS d
      FROM interactions i JOIN places_nulls p
        ON p.lat BETWEEN i.lat - {D(band)} AND i.lat + {D(band)} AND p.lon BETWEEN i.lon - {D(band * 2)} AND i.lon + {D(band * 2)})
    SELECT point_id, feature_id, round(d, 3) AS distance_m FROM (
      SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d, feature_id) AS k FROM pairs WHERE d <= {D(radius)})
    WHERE k = 1"""
    hour = q.HOUR_MS * 1000
    throttled = f"""{next_pass(f"{INTERACTIONS}, considered AS (SELECT * FROM interactions)", "session", hour)}
      SELECT event_id, session FROM passed"""
    diff_rows = f"""WITH {MOVED}, prev AS (SELECT * FROM places WHERE feature_id % 1000 <> 1),
      curr AS (SELECT feature_id, lon, lat, CASE WHEN feature_id % 7 = 0 THEN 0 ELSE value END AS value, category
               FROM moved WHERE feature_id % 1000 <> 2),
      pair AS (SELECT coalesce(p.feature_id, c.feature_id) AS feature_id, p.feature_id IS NULL AS is_new,
               c.feature_id IS NULL AS is_gone,
               p.lon IS DISTINCT FROM c.lon AS d1, p.lat IS DISTINCT FROM c.lat AS d2,
               p.value IS DISTINCT FROM c.value AS d3, p.category IS DISTINCT FROM c.category AS d4
               FROM prev p FULL OUTER JOIN curr c ON p.feature_id = c.feature_id)
      SELECT feature_id, CASE WHEN is_new THEN 'added' WHEN is_gone THEN 'removed'
        WHEN NOT (d1 OR d2 OR d3 OR d4) THEN 'unchanged' WHEN d1 OR d2 THEN 'geometry_changed'
        ELSE 'accessors_only' END AS verdict,
        CASE WHEN is_new OR is_gone THEN '' ELSE concat_ws(',', CASE WHEN d1 THEN 'lon' END,
        CASE WHEN d2 THEN 'lat' END, CASE WHEN d3 THEN 'value' END, CASE WHEN d4 THEN 'category' END) END
        AS changed_columns FROM pair"""
    changed = f"""{MOVED}, facts AS (
      SELECT bool_or(p.value IS DISTINCT FROM p.value * {D(1.1)}) AS values_differ,
             bool_or(p.lon IS DISTINCT FROM m.lon) AS shapes_differ FROM places p JOIN moved m USING (feature_id))"""
    diff_layers = f"""WITH {changed}
      SELECT 'same' AS layer_id, 'unchanged' AS verdict, '' AS changed_columns, false AS props_changed, false AS moved FROM facts
      UNION ALL SELECT 'values', CASE WHEN values_differ THEN 'accessors_only' ELSE 'unchanged' END,
        CASE WHEN values_differ THEN 'get_elevation' ELSE '' END, false, false FROM facts
      UNION ALL SELECT 'shapes', CASE WHEN shapes_differ THEN 'geometry_changed' ELSE 'unchanged' END,
        CASE WHEN shapes_differ THEN 'geometry' ELSE '' END, false, false FROM facts
      UNION ALL SELECT 'style', 'props_only', '', true, false FROM facts
      UNION ALL SELECT 'hover', 'accessors_only', 'name', false, false FROM facts
      UNION ALL SELECT 'gone', 'removed', '', false, false FROM facts
      UNION ALL SELECT 'fresh', 'new', '', false, false FROM facts"""
    feed = f"""WITH {changed}
      SELECT 1 AS version, 'layer-0' AS layer_id, 'new' AS verdict, '' AS changed_columns FROM facts
      UNION ALL SELECT 2, 'layer-0', CASE WHEN values_differ THEN 'accessors_only' ELSE 'unchanged' END,
        CASE WHEN values_differ THEN 'get_elevation' ELSE '' END FROM facts
      UNION ALL SELECT 3, 'layer-0', CASE WHEN shapes_differ THEN 'geometry_changed' ELSE 'accessors_only' END,
        CASE WHEN shapes_differ THEN 'geometry,get_elevation' ELSE 'get_elevation' END FROM facts
      UNION ALL SELECT 4, 'layer-0', 'unchanged', '' FROM facts"""
    lt = "l_linenumber AS n, l_returnflag AS mode, l_quantity AS ms, l_extendedprice AS b"
    summary = """s AS (SELECT n, mode, count(*) AS runs, max(b) AS wire_bytes, quantile_cont(ms, 0.5) AS median_ms
      FROM runs GROUP BY ALL)"""
    views = f"""WITH {INTERACTIONS} SELECT session, event_id, t, longitude, latitude, zoom, bearing FROM (
      SELECT *, row_number() OVER (PARTITION BY session ORDER BY t DESC, event_id DESC) AS k FROM interactions WHERE kind = 'view_state') WHERE k = 1"""
    scatter = f"""SELECT o_orderkey AS feature_id, {D(gen.BOX[0])} + {uniform('o_orderkey', 3, 0)} * {D(gen.BOX[2] - gen.BOX[0])} AS lon,
      {D(gen.BOX[1])} + {uniform('o_orderkey', 3, 1)} * {D(gen.BOX[3] - gen.BOX[1])} AS lat,
      {', '.join(f"CAST(floor({uniform('o_orderkey', 3, i)} * 255) AS INTEGER) AS {c}" for i, c in ((2, 'r'), (3, 'g'), (4, 'b')))},
      round(CAST(CAST({D(20)} + {uniform('o_orderkey', 3, 5)} * {D(180)} AS FLOAT) AS DOUBLE), 3) AS radius FROM orders"""
    cluster = f"CAST(floor({uniform('o_orderkey', 3, 0)} * {D(gen.CLUSTERS)}) AS BIGINT)"
    normal = f"sqrt({D(-2.0)} * ln({D(1.0)} - {uniform('o_orderkey', 3, 3)}))"
    angle = f"({D(2 * math.pi)} * {uniform('o_orderkey', 3, 4)})"
    clustered = f"""WITH c AS (SELECT o_orderkey, {cluster} AS cluster FROM orders)
      SELECT o_orderkey AS feature_id, cluster,
      round({D(gen.BOX[0])} + {uniform('cluster', 4, 1)} * {D(gen.BOX[2] - gen.BOX[0])} + {normal} * cos({angle}) * {D(gen.JITTER)}, 9) AS lon,
      round({D(gen.BOX[1])} + {uniform('cluster', 4, 2)} * {D(gen.BOX[3] - gen.BOX[1])} + {normal} * sin({angle}) * {D(gen.JITTER)}, 9) AS lat
      FROM c"""
    vertex_parts = f"""WITH {VERTICES}, cut AS (
      SELECT *, CASE WHEN n > {q.PART_VERTICES} THEN place // {parts} ELSE 0 END AS part,
        n > {q.PART_VERTICES} AND place % {parts} = 0 AND place > 0 AS meets FROM vertices),
      both_parts AS (
        SELECT user_id, part, place - part * {parts} AS vertex, lon, lat FROM cut WHERE NOT (meets AND place = n - 1)
        UNION ALL SELECT user_id, part - 1, {parts}, lon, lat FROM cut WHERE meets)
      SELECT * FROM both_parts"""
    thin = f"""WITH {VERTICES}, r AS (
      SELECT user_id, place, n, round(lon, 0) AS lon, round(lat, 0) AS lat FROM vertices),
      m AS (SELECT *, place = 0 OR lag(lon) OVER w IS DISTINCT FROM lon OR lag(lat) OVER w IS DISTINCT FROM lat AS keep
            FROM r WINDOW w AS (PARTITION BY user_id ORDER BY place)),
      c AS (SELECT *, sum(CAST(keep AS INTEGER)) OVER (PARTITION BY user_id) AS kept FROM m)
      SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY place) - 1 AS vertex, lon, lat FROM c
      WHERE CASE WHEN kept >= 2 THEN keep ELSE place = 0 OR place = n - 1 END
      UNION ALL SELECT user_id, 1, lon, lat FROM c WHERE n = 1"""
    view = to_json({"longitude": -122.45, "latitude": 37.75, "zoom": 10.0, "pitch": 0.0, "bearing": 0.0}, "v")
    tier = "CASE WHEN bytes >= 20000000 THEN 'parquet' WHEN bytes >= 1000000 THEN 'ipc-zstd' ELSE 'ipc' END"
    budget_sizes = f"WITH {PLACES} SELECT 'layer-0' AS layer_id, count(*) AS rows, count(*) * 28 AS bytes FROM places UNION ALL SELECT 'layer-1', count(*), count(*) * (8 + 8 + 15 + 4) FROM part"
    out = {
        "flagship": f"""WITH {ramp} SELECT feature_id, lon AS geom_x, lat AS geom_y, CAST(radius AS DOUBLE) AS get_radius,
          category, name, {coloured} FROM places_nulls, edges WHERE lon IS NOT NULL""",
        "scan_layer": "SELECT o_orderkey, o_totalprice FROM orders",
        "scan_cell_stats": level6,
        "gen_points": scatter,
        "gen_clustered": clustered,
        "square_grid": " UNION ALL ".join(
            f"SELECT p_partkey AS feature_id, {i} AS corner, {ring_corner(i)[0]} AS x, {ring_corner(i)[1]} AS y FROM part"
            for i in range(5)
        ),
        "layer_select": f"WITH {PLACES} SELECT feature_id, lon AS geom_x, lat AS geom_y, radius AS get_radius, category, name FROM places",
        "tooltip_all": f"WITH {PLACES} SELECT feature_id, lon AS geom_x, lat AS geom_y, radius AS get_radius, category, lat, lon, name, radius, value FROM places",
        "tooltip_text": f"SELECT event_id, {div('event_type', 'event_type')} || {div('props', 'props')} || {div('user_id', 'CAST(user_id AS VARCHAR)')} || {div('value', number_text('value'))} AS tooltip FROM events",
        "points_3d": f"WITH {NULLS} SELECT feature_id, CASE WHEN lon IS NOT NULL THEN 3 END AS dims, lon AS x, lat AS y, CASE WHEN lon IS NOT NULL THEN CAST(radius AS DOUBLE) END AS z FROM places_nulls",
        "trip_paths": f"WITH {VERTICES} SELECT user_id, CAST(0 AS BIGINT) AS part, place AS vertex, lon, lat, t FROM vertices",
        "trip_parts": vertex_parts,
        "trip_times": f"WITH {VERTICES} SELECT user_id, place AS vertex, t // 1000000 - (SELECT min(t // 1000000) FROM vertices) - 16777216 AS t FROM vertices",
        "arcs": f"WITH {ARCS} SELECT l_orderkey, l_linenumber, src_lon AS src_x, src_lat AS src_y, dst_lon AS dst_x, dst_lat AS dst_y FROM arcs",
        "attach_colors": f"WITH {COLOURS} SELECT feature_id, r, g, b FROM coloured",
        "color_ramp": f"WITH {ramp} SELECT feature_id, {coloured} FROM places_nulls, edges",
        "ramp_bounds": bounds,
        "ramp_bounds_hot": bounds,
        "recolor": f"WITH {COLOURS} SELECT feature_id, r, (g + 200) % 256 AS g, b FROM coloured",
        "null_geometry": f"WITH {NULLS} SELECT count(*) AS rows, count(*) - count(lon) AS null_rows FROM places_nulls",
        "null_geometry_drop": f"WITH {NULLS} SELECT feature_id, lon AS geom_x, lat AS geom_y FROM places_nulls WHERE lon IS NOT NULL",
        "contract_report": f"""WITH {NULLS} SELECT count(*) AS rows, CAST(0 AS BIGINT) AS null_id, count(*) - count(lon) AS geometry_null,
          CAST(0 AS BIGINT) AS geometry_length,
          count(*) FILTER (NOT (lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90)) AS geometry_range,
          count(*) FILTER (isnan(lon)) AS geometry_finite, count(*) FILTER (isnan(value)) AS get_elevation_finite FROM places_nulls""",
        "contract_trips": """WITH per AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
          SELECT count(*) AS rows, CAST(0 AS BIGINT) AS null_id, CAST(0 AS BIGINT) AS geometry_null,
          count(*) FILTER (n < 2) AS geometry_length, CAST(0 AS BIGINT) AS geometry_range,
          CAST(0 AS BIGINT) AS geometry_finite, CAST(0 AS BIGINT) AS times_length FROM per""",
        "finite_report": f"WITH {NULLS} SELECT count(*) FILTER (isnan(lon)) AS lon, count(*) FILTER (isnan(lat)) AS lat, count(*) FILTER (isnan(value)) AS value FROM places_nulls",
        "finite_drop": f"WITH {NULLS} SELECT feature_id, value FROM places_nulls WHERE NOT isnan(value)",
        "range_filter": f"WITH {NULLS} SELECT feature_id, value, CAST(radius AS DOUBLE) AS radius FROM places_nulls WHERE value BETWEEN 50000 AND 200000 AND radius BETWEEN 40 AND 150",
        "range_filter_soft": f"""WITH {PLACES} SELECT feature_id, round(least({D(1)}, (value - 50000) / {D(30000)}, (200000 - value) / {D(50000)}), 9) AS filter_weight
          FROM places WHERE value BETWEEN 50000 AND 200000""",
        "category_filter": f"WITH {PLACES} SELECT feature_id, category, name FROM places WHERE category IN ('1-URGENT', '5-LOW') AND name IN ('O', 'F')",
        "brush": f"WITH {PLACES} SELECT feature_id, lon, lat FROM places WHERE {near('lon', 'lat')}",
        "brush_arcs": f"WITH {ARCS} SELECT * FROM arcs WHERE {near('src_lon', 'src_lat')} OR {near('dst_lon', 'dst_lat')}",
        "in_view": f"WITH {NULLS} SELECT feature_id, lon, lat FROM places_nulls WHERE {box_where('lon', 'lat', box)}",
        "declutter": f"""WITH {NULLS} SELECT feature_id, category, lon, lat FROM (SELECT *, row_number() OVER (PARTITION BY category,
          floor((lon + {D(180)}) / {D(0.01)}), floor((lat + {D(90)}) / {D(0.01)}) ORDER BY value DESC, feature_id) AS k
          FROM places_nulls WHERE lon IS NOT NULL) WHERE k = 1""",
        "fit_to_budget": f"""WITH {PLACES}, b AS (SELECT feature_id, CAST('0x' || substr(md5(CAST(feature_id AS VARCHAR)), 1, 4) AS INTEGER) AS bucket FROM places),
          s AS (SELECT bucket, sum(sum(28)) OVER (ORDER BY bucket) AS total FROM b GROUP BY bucket),
          cut AS (SELECT coalesce(min(bucket), 65536) AS c FROM s WHERE total > (SELECT count(*) * 14 FROM places))
          SELECT feature_id FROM b, cut WHERE bucket < c""",
        "coarsen": f"WITH {PLACES} SELECT feature_id, round(lon, 3) AS geom_x, round(lat, 3) AS geom_y FROM places",
        "coarsen_paths": thin,
        "float_geometry": f"WITH {PLACES} SELECT feature_id, CAST(CAST(lon AS FLOAT) AS DOUBLE) AS geom_x, CAST(CAST(lat AS FLOAT) AS DOUBLE) AS geom_y FROM places",
        "check_budget": budget_sizes,
        "budget_verdict": f"SELECT layer_id, bytes, CAST(sum(bytes) OVER () AS BIGINT) AS total, sum(bytes) OVER () > 50000 AS over_limit FROM ({budget_sizes})",
        "attach_stats": f"""WITH {GRID}, s AS (SELECT l_partkey AS cell_id, count(*) AS count, min(l_quantity) AS min, max(l_quantity) AS max,
          round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem GROUP BY 1)
          SELECT * FROM grid JOIN s USING (cell_id)""",
        "resolve_picks": f"WITH {PICKED} SELECT event_id, layer_id, row_index, no_index, known_layer, lon, lat FROM resolved",
        "lookup_rows": f"WITH {PICKED} SELECT event_id, i.* FROM resolved r JOIN indexed i USING (layer_id, row_index)",
        "hover_rows": f"""WITH {PICKED} SELECT event_id, layer_id, row_index, {div('name', 'i.name')} || {div('category', 'i.category')} || {div('value', number_text('i.value'))} AS tooltip
          FROM resolved r JOIN indexed i USING (layer_id, row_index)""",
        "nearest_feature": nearest,
        "nearest_feature_dense": nearest,
        "diff_layers": diff_layers,
        "diff_rows": diff_rows,
        "changed_rows": f"""WITH {MOVED} SELECT feature_id, m.lon, 'geometry_changed' AS verdict FROM moved m JOIN places p USING (feature_id) WHERE p.lon <> m.lon""",
        "viewport": f"""WITH {NULLS}, v AS (SELECT avg(lon) AS longitude, avg(lat) AS latitude, min(lon) AS west, min(lat) AS south, max(lon) AS east,
          max(lat) AS north, count(*) - count(lon) AS skipped FROM places_nulls)
          SELECT round(longitude, 6) AS longitude, round(latitude, 6) AS latitude,
          round(least(greatest(log2({D(360)} / greatest(east - west, north - south)), 0), 20), 6) AS zoom, west, south, east, north, skipped FROM v""",
        "layer_bytes": "SELECT 'layer-0' AS layer_id, count(*) AS rows, count(*) * (8 + 23) AS bytes FROM orders",
        "encoding_tier": f"""WITH s AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS layer_id, count(*) * 23000 AS bytes FROM lineitem GROUP BY 1)
          SELECT layer_id, bytes, {tier} AS encoding FROM s""",
        "format_sizes": f"""WITH {PLACES}, s AS (SELECT count(*) AS rows, CAST(sum(8 + 4 + strlen(category) + 4 + strlen(name)) AS BIGINT) AS arrow_bytes,
          CAST(sum(strlen('{{"feature_id":' || feature_id || ',"category":"' || category || '","name":"' || name || '"}}') + 1) AS BIGINT) AS json_bytes FROM places)
          SELECT *, round(json_bytes / arrow_bytes, 6) AS ratio FROM s""",
        "column_fingerprints": f"""WITH {PLACES} """
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {md5_sum(t)} AS fingerprint, count(*) AS rows FROM places"
            for c, t in (
                ("feature_id", "CAST(feature_id AS VARCHAR)"),
                ("lon", scaled("lon")),
                ("lat", scaled("lat")),
                ("value", scaled("value")),
                ("category", "category"),
                ("name", "name"),
            )
        ),
        "geometry_fingerprint": f"WITH {PLACES} SELECT 'get_geohash:' || {md5_sum('name')} AS geometry_fp, count(*) AS rows FROM places",
        "geohash_cell": f"WITH {NULLS}, coded AS (SELECT feature_id, {geohash_code('lon', 'lat', 7)} AS code FROM places_nulls) SELECT feature_id, {geohash_text('code', 7)} AS get_geohash FROM coded",
        "geohash_rollup": rolled5,
        "geohash_rollup_hot": rolled5,
        "h3_rollup": f"WITH {H3}, p AS (SELECT {h3_parent('cell', 8)} AS parent, value FROM h3) {rollup('p', 'parent')}",
        "h3_cells": f"WITH {H3} SELECT feature_id, cell, CAST((cell >> 52) & 15 AS INTEGER) AS resolution, {h3_parent('cell', 7)} AS parent, lower(to_hex({h3_parent('cell', 7)})) AS parent_text FROM h3",
        "bench_summary": f"""WITH runs AS (SELECT {lt} FROM lineitem), {summary}
          SELECT s.*, p.wire_bytes AS plain_bytes, p.median_ms AS plain_ms, round(s.wire_bytes / p.wire_bytes, 6) AS ratio
          FROM s LEFT JOIN (SELECT * FROM s WHERE mode = 'N') p USING (n)""",
        "break_even": f"""WITH runs AS (SELECT 1 AS n, CAST(l_partkey AS VARCHAR) AS mode, l_quantity AS ms, l_extendedprice AS b FROM lineitem), {summary},
          d AS (SELECT s.mode, p.wire_bytes - s.wire_bytes AS saved, s.median_ms - p.median_ms AS added
                FROM s LEFT JOIN (SELECT * FROM s WHERE mode = '1') p USING (n))
          SELECT mode, round(saved, 2) AS bytes_saved, added AS added_ms,
            round(CASE WHEN saved > 0 AND added > 0 THEN saved * 8 / (added / {D(1000)}) / {D(1e6)} END, 9) AS break_even_mbps FROM d""",
        "span_totals": """SELECT event_type AS span, count(value) AS count, round(sum(value), 2) AS total_ms, max(value) AS max_ms,
          count(*) FILTER (value > 50) AS long_count, round(coalesce(sum(value) FILTER (value > 50), 0), 2) AS long_total_ms,
          coalesce(max(value) FILTER (value > 50), 0) AS long_max_ms FROM events GROUP BY 1""",
        "row_offsets": f"WITH {PARTS} SELECT layer_id, batch_id, num_rows, row_offset FROM sub_layers",
        "byte_offsets": f"""WITH {PLACES}, l AS (SELECT name AS map_id, category AS layer_id, count(*) * 23 AS byte_length,
          CAST(substr(category, 1, 1) AS INTEGER) AS position FROM places GROUP BY name, category)
          SELECT *, CAST(coalesce(sum(byte_length) OVER (PARTITION BY map_id ORDER BY position
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset FROM l""",
        "row_index": "SELECT o_orderkey AS feature_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders",
        "assign_batches": """WITH b AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch_id FROM orders)
          SELECT 'layer-0' AS layer_id, batch_id, 'layer-0-' || batch_id AS sub_layer_id, count(*) AS num_rows,
          batch_id * 1000 AS row_offset FROM b GROUP BY batch_id""",
        "sort_for_encoding": f"WITH {PLACES} SELECT feature_id, code, row_number() OVER (ORDER BY code, feature_id) - 1 AS position FROM (SELECT feature_id, {geohash_code('lon', 'lat', 6)} AS code FROM places)",
        "hilbert_order": f"""WITH RECURSIVE {NULLS}, curve AS (
            SELECT feature_id, CAST(32768 AS BIGINT) AS side, CAST(0 AS BIGINT) AS code,
              CAST(floor((lon + {D(180.0)}) / {D(360.0)} * {D(65536.0)}) AS BIGINT) AS x,
              CAST(floor((lat + {D(90.0)}) / {D(180.0)} * {D(65536.0)}) AS BIGINT) AS y
            FROM places_nulls WHERE lon IS NOT NULL
            UNION ALL
            SELECT feature_id, side // 2, code + CAST(side AS BIGINT) * side * CASE
                WHEN x & side > 0 AND y & side > 0 THEN 2 WHEN x & side > 0 THEN 3 WHEN y & side > 0 THEN 1 ELSE 0 END,
              CASE WHEN y & side > 0 THEN x WHEN x & side > 0 THEN 65535 - y ELSE y END,
              CASE WHEN y & side > 0 THEN y WHEN x & side > 0 THEN 65535 - x ELSE x END
            FROM curve WHERE side > 0)
          SELECT feature_id, c.code, row_number() OVER (ORDER BY c.code NULLS FIRST, feature_id) - 1 AS position
          FROM places_nulls LEFT JOIN (SELECT feature_id, code FROM curve WHERE side = 0) c USING (feature_id)""",
        "stack_layers": f"""WITH {PLACES}, {H3} SELECT feature_id, name, value, CAST(NULL AS VARCHAR) AS cell, 'layer-0' AS layer_id, 0 AS position FROM places
          UNION ALL SELECT feature_id, NULL, value, lower(to_hex(cell)), 'layer-1', 1 FROM h3""",
        "layer_parquet": f"WITH {COLOURS} SELECT feature_id, lon AS geom_x, lat AS geom_y, name, r, g, b FROM coloured",
        "encoded_batches": """WITH b AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 2000 AS batch_id FROM orders)
          SELECT 'layer-0' AS layer_id, batch_id, count(*) AS num_rows, 'ipc-zstd' AS encoding FROM b GROUP BY batch_id""",
        "encoded_values": f"""WITH {COLOURS} SELECT feature_id, lon AS geom_x, lat AS geom_y, radius, name, r, g, b, encoding
          FROM coloured, (VALUES ('ipc'), ('ipc-zstd'), ('parquet')) e(encoding)""",
        "layers_partitioned": """SELECT 'layer-0' AS layer_id, 'parquet' AS encoding, (count(*) + 3999) // 4000 AS batches, count(*) AS num_rows FROM orders
          UNION ALL SELECT 'layer-1', 'ipc', (count(*) + 499) // 500, count(*) FROM part""",
        "records_json": f"""WITH {PLACES} SELECT feature_id, '{{"feature_id":' || feature_id || ',"name":"' || name || '","category":"' || category || '"}}' AS record FROM places""",
        "manifest_files": """WITH l AS (SELECT 'places' AS layer_id, count(*) AS n, 6 AS fingerprints FROM orders
            UNION ALL SELECT 'cells', count(*), 2 FROM part)
          SELECT layer_id, n AS num_rows, (n + 1999) // 2000 AS batches, CAST(1 AS BIGINT) AS encodings, true AS encoding_agrees, true AS length_agrees,
          true AS offset_agrees, fingerprints, true AS has_geometry_fp, (n + 1999) // 2000 * 2000 - 2000 AS last_offset,
          CAST(n AS BIGINT) AS sub_layer_rows, CAST(NULL AS VARCHAR) AS time_unit FROM l""",
        "manifest": f"""SELECT 'map' AS map_id, 1 AS version, 0 AS position, 'places' AS layer_id, 'scatterplot' AS layer_type,
          '{{"getFillColor": {{"@@arrowColumn": "get_fill_color"}}, "getRadius": {{"@@arrowColumn": "get_radius"}}, "radiusUnits": "meters"}}' AS props,
          '[{{"props": {{"filterSize": 1}}, "type": "data-filter"}}]' AS extensions, '["category", "name"]' AS tooltip, count(*) AS num_rows,
          CAST(sum(31 + 4 + strlen(o_orderpriority) + 4 + strlen(o_orderstatus)) AS BIGINT) AS bytes, '{view}' AS view_state FROM orders
          UNION ALL SELECT 'map', 1, 1, 'cells', 'h3-hexagon', '{{"getHexagon": {{"@@arrowColumn": "get_hexagon"}}}}', NULL, NULL, count(*), count(*) * 16, '{view}' FROM part""",
        "refresh_map": "SELECT 'places' AS layer_id, true AS kept_data, 'get_fill_color' AS patched FROM orders HAVING count(*) > 0 UNION ALL SELECT 'cells', true, NULL FROM part HAVING count(*) > 0",
        "gate": f"WITH {INTERACTIONS} SELECT event_id, session, kind FROM interactions WHERE kind = 'clicked' OR (kind = 'hovered' AND session % 2 = 0)",
        "gate_stream": f"WITH {INTERACTIONS} SELECT event_id, session, kind FROM interactions WHERE kind <> 'clicked'",
        "throttle": throttled,
        "throttle_pieces": f"""{next_pass(f"{INTERACTIONS}, considered AS (SELECT * FROM interactions)", "session", 24 * hour)} SELECT event_id, session FROM passed""",
        "throttle_kinds": f"""{next_pass(f"{INTERACTIONS}, considered AS (SELECT * FROM interactions WHERE kind <> 'clicked')", "session, kind", 12 * hour)}
          SELECT event_id, session, kind FROM passed UNION ALL SELECT event_id, session, kind FROM interactions WHERE kind = 'clicked'""",
        "throttle_stream": throttled,
        "throttle_kinds_stream": f"""{next_pass(f"{INTERACTIONS}, considered AS (SELECT * FROM interactions WHERE kind <> 'clicked')", "session, kind", 12 * hour)}
          SELECT event_id, session, kind FROM passed UNION ALL SELECT event_id, session, kind FROM interactions WHERE kind = 'clicked'""",
        "latest_view": views,
        "latest_view_stream": views,
        "picks_to_rows": f"WITH {PICKED} SELECT event_id, layer_id, row_index, feature_id, i.name FROM resolved r JOIN indexed i USING (layer_id, row_index)",
        "picks_to_rows_stream": f"WITH {PICKED} SELECT event_id, layer_id, row_index, feature_id, i.name FROM resolved r JOIN indexed i USING (layer_id, row_index)",
        "layer_change_feed": feed,
    }
    return out
