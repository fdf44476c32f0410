"""Column functions, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed import FLAGS, MAP_BOUNDS
from ..functions import conditions, geo, strings, times, units
from ..functions.nested import location
from ..operators import cleaning, relational, report
from ..operators.roads import name_road_key
from ..session import scratch_path
from ..sources.streams import as_messages
from ..streaming import points as point_steps
from ..streaming import scoring
from .base import cte, icon_class_sql, icon_text, load, query, standin, weather_dim_sql

# ---------------------------------------------------------------- text


@query(
    "str_split_address",
    f"""WITH {cte('address_lines')}
    SELECT line, trim(split_part(line, '#', 1)) AS street,
      trim(substr(line, strpos(line, '#') + 1)) AS details,
      trim(split_part(line, '#', 1)) || ', ' || trim(substr(line, strpos(line, '#') + 1)) AS address
    FROM address_lines WHERE strpos(line, '#') > 0""",
)
def str_split_address(spark, sf):
    line = F.col("line")
    return (
        standin(spark, sf, "address_lines")
        .filter(line.contains("#"))
        .select(
            "line",
            strings.street_of(line).alias("street"),
            strings.details_of(line).alias("details"),
            strings.full_address(line).alias("address"),
        )
    )


@query(
    "token_sort",
    """WITH words AS (
      SELECT p_partkey, upper(p_name) || ' - ' || p_type || ', no. ' || p_size AS raw FROM part)
    SELECT p_partkey, raw, array_to_string(list_sort(string_split(trim(lower(
      regexp_replace(raw, '[^A-Za-z0-9_]+', ' ', 'g'))), ' ')), ' ') AS sorted
    FROM words""",
)
def token_sort(spark, sf):
    raw = F.concat(
        F.upper("p_name"), F.lit(" - "), F.col("p_type"), F.lit(", no. "), F.col("p_size").cast("string")
    )
    return (
        load(spark, sf, "part")
        .select("p_partkey", raw.alias("raw"))
        .withColumn("sorted", strings.token_sort(F.col("raw")))
    )


@query(
    "token_sort_texts",
    """SELECT doc_id, array_to_string(list_sort(string_split(trim(lower(regexp_replace(
      regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9_]+', ' ', 'g'))), ' ')), ' ') AS sorted
    FROM documents""",
)
def token_sort_texts(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", strings.token_sort(F.col("text")).alias("sorted")
    )


@query(
    "key_value",
    """SELECT event_id, event_type || '=' || props AS pair FROM events""",
)
def key_value(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", strings.key_value(F.col("event_type"), F.col("props")).alias("pair")
    )


# ---------------------------------------------------------------- numbers


@query(
    "unit_f_to_c",
    """SELECT l_orderkey, l_linenumber, (l_quantity - 32) * (5e0 / 9e0) AS celsius FROM lineitem""",
)
def unit_f_to_c(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", units.f_to_c(F.col("l_quantity")).alias("celsius")
    )


@query(
    "round_int",
    """SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice / 100) AS INTEGER) AS nearest,
      CAST(round((l_quantity - 25) / 2) AS INTEGER) AS nearest_half FROM lineitem""",
)
def round_int(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        units.round_int(F.col("l_extendedprice") / 100).alias("nearest"),
        units.round_int((F.col("l_quantity") - 25) / 2).alias("nearest_half"),
    )


@query(
    "unit_truncate",
    f"""WITH {cte('points')}
    SELECT event_id,
      CAST(trunc("pressure_hPa" * 0.02953e0) AS INTEGER) AS inhg,
      CAST(trunc("wind_speed_meterSec" * 2.23694e0) AS INTEGER) AS mph,
      CAST(round("pressure_hPa" * 0.02953e0) AS INTEGER) AS inhg_rounded,
      CAST(round("wind_speed_meterSec" * 2.23694e0) AS INTEGER) AS mph_rounded
    FROM points""",
)
def unit_truncate(spark, sf):
    hpa, mps = F.col("pressure_hPa"), F.col("wind_speed_meterSec")
    return standin(spark, sf, "points").select(
        "event_id",
        units.hpa_to_inhg(hpa).alias("inhg"),
        units.mps_to_mph(mps).alias("mph"),
        units.hpa_to_inhg(hpa, "round").alias("inhg_rounded"),
        units.mps_to_mph(mps, "round").alias("mph_rounded"),
    )


@query(
    "boxcox_apply",
    """SELECT l_orderkey, l_linenumber, round((pow(l_quantity + 1, 0.3e0) - 1) / 0.3e0, 6) AS powered,
      round((pow(l_quantity + 1, -0.5e0) - 1) / -0.5e0, 6) AS inverse,
      round(ln(l_quantity + 1), 6) AS logged FROM lineitem""",
)
def boxcox_apply(spark, sf):
    x = F.col("l_quantity") + 1
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(units.boxcox(x, 0.3), 6).alias("powered"),
        F.round(units.boxcox(x, -0.5), 6).alias("inverse"),
        F.round(units.boxcox(x, 0.0), 6).alias("logged"),
    )


# ---------------------------------------------------------------- conditions


@query(
    "bool_to_int",
    f"""WITH {cte('accidents')}
    SELECT {', '.join(f'coalesce(CAST("{f}" AS INTEGER), -1) AS "{f}"' for f in FLAGS)}, count(*) AS n
    FROM accidents GROUP BY ALL""",
)
def bool_to_int(spark, sf):
    """Flag combinations; a flag that stays null is shown as -1."""
    flags = standin(spark, sf, "accidents").select(
        *[F.coalesce(conditions.bool_to_int(F.col(f)), F.lit(-1)).alias(f) for f in FLAGS]
    )
    return flags.groupBy(*FLAGS).agg(F.count(F.lit(1)).alias("n"))


@query(
    "day_night",
    f"""WITH {cte('points')}
    SELECT event_id, CASE WHEN substr(weather_icon, 3, 1) = 'd' THEN 'Day' ELSE 'Night' END
      AS "Sunrise_Sunset" FROM points""",
)
def day_night(spark, sf):
    return standin(spark, sf, "points").select(
        "event_id", conditions.day_night(F.col("weather_icon")).alias("Sunrise_Sunset")
    )


@query(
    "icon_class",
    f"""WITH {cte('points')}
    SELECT event_id, weather_icon, {icon_class_sql('weather_icon')} AS class FROM points""",
)
def icon_class(spark, sf):
    return standin(spark, sf, "points").select(
        "event_id", "weather_icon", conditions.icon_class(F.col("weather_icon")).alias("class")
    )


@query(
    "classify_weather",
    f"""WITH {cte('accidents')}, {weather_dim_sql()}
    SELECT coalesce(d.class, 'Unknown') AS "Weather_Condition", a."Weather_Condition" AS raw,
      count(*) AS n
    FROM accidents a LEFT JOIN weather_dim d ON a."Weather_Condition" = d.raw GROUP BY ALL""",
)
def classify_weather(spark, sf):
    rows = standin(spark, sf, "accidents").select(
        "Weather_Condition", F.col("Weather_Condition").alias("raw")
    )
    classed = cleaning.classify(rows, "Weather_Condition", cleaning.weather_dimension(spark))
    return classed.groupBy("Weather_Condition", "raw").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- time


@query(
    "epoch_to_ts",
    """SELECT event_id,
      strftime(make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000),
        '%Y-%m-%dT%H:%M:%S.000Z') AS iso,
      CASE WHEN event_id % 10 = 0 THEN NULL ELSE
      strftime(make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000),
        '%Y-%m-%dT%H:%M:%S.000Z') END AS iso_from_text
    FROM events""",
)
def epoch_to_ts(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    text = F.when(F.col("event_id") % 10 == 0, F.lit("soon")).otherwise(seconds.cast("string"))
    return load(spark, sf, "events").select(
        "event_id",
        times.to_iso8601(times.epoch_to_timestamp(seconds)).alias("iso"),
        times.to_iso8601(times.epoch_to_timestamp(text)).alias("iso_from_text"),
    )


@query(
    "parse_iso_or_epoch",
    """SELECT event_id, CASE WHEN event_id % 5 = 4 THEN -1
      ELSE CAST(floor(epoch_us(ts) / 1000) AS BIGINT) END AS millis FROM events""",
)
def parse_iso_or_epoch(spark, sf):
    ts = F.col("ts").cast("timestamp")
    iso, number = times.to_iso8601(ts), F.unix_millis(ts).cast("string")
    text = (
        F.when(F.col("event_id") % 5 == 4, F.lit("not a time"))
        .when(F.col("event_id") % 2 == 0, iso)
        .otherwise(number)
    )
    return load(spark, sf, "events").select(
        "event_id",
        F.coalesce(F.unix_millis(times.parse_iso_or_epoch(text)), F.lit(-1)).alias("millis"),
    )


# ---------------------------------------------------------------- projections

_scored_sql = """
  SELECT way_id, highway, name, CAST(trunc("Temperature_C") AS INTEGER) AS "Temperature(C)",
    CAST("Humidity_%" AS INTEGER) AS "Humidity(%)",
    CAST(trunc("pressure_hPa" * 0.02953e0) AS INTEGER) AS "Pressure(in)",
    CAST(trunc("wind_speed_meterSec" * 2.23694e0) AS INTEGER) AS "Wind_Speed(mph)",
    CASE WHEN substr(weather_icon, 3, 1) = 'd' THEN 'Day' ELSE 'Night' END AS "Sunrise_Sunset",
    {icon} AS "Weather_Condition", "Amenity", "Give_Way", "Crossing", "Traffic_Calming",
    "Traffic_Signal", "Railway", "Stop", "No_Exit", "Junction", lat AS location_lat,
    lon AS location_lon,
    CAST(epoch_ms(CAST(replace(replace(weather_timestamp_iso8601, 'T', ' '), 'Z', '') AS TIMESTAMP))
      AS BIGINT) AS weather_millis, (event_id % 1000) / 1e3 AS danger_index
  FROM points"""


@query("proj_select", f"WITH {cte('points')} {_scored_sql.format(icon=icon_class_sql('weather_icon'))}")
def proj_select(spark, sf):
    """The 21 scored columns of point rows with a given prediction; location shown flat."""
    points = standin(spark, sf, "points").withColumns(
        {
            "prediction": F.col("event_id") % 1000 / F.lit(1000.0),
            "Temperature_C": F.col("Temperature_C").cast("int"),
            "Humidity_%": F.col("`Humidity_%`").cast("int"),
        }
    )
    scored = scoring.shape_scored(scoring.derive_conditions(points))
    return scored.select(
        *[F.col(f"`{c}`") for c in scored.columns if c not in ("location", "weather_timestamp_iso8601")],
        F.col("location.lat").alias("location_lat"),
        F.col("location.lon").alias("location_lon"),
        F.unix_millis("weather_timestamp_iso8601").alias("weather_millis"),
    )


@query(
    "proj_rename",
    f"""WITH {cte('roads')}
    SELECT input_street AS "Street", input_city AS "City", input_county AS "County",
      input_state AS "State" FROM roads""",
)
def proj_rename(spark, sf):
    """The road table's key columns under the accident table's names, without the road type."""
    return name_road_key(standin(spark, sf, "roads")).drop("highway")


@query(
    "proj_whitelist",
    f"""WITH {cte('points')}
    SELECT way_id, highway, name, lat, lon, "Stop" FROM points""",
)
def proj_whitelist(spark, sf):
    names = ["way_id", "highway", "name", "lat", "lon", "Stop", "not_there"]
    return relational.whitelist(standin(spark, sf, "points"), names)


@query(
    "proj_location",
    f"""WITH {cte('scored')}
    SELECT event_id, lat, lon FROM scored""",
)
def proj_location(spark, sf):
    scored = standin(spark, sf, "scored").withColumn("location", location(F.col("lat"), F.col("lon")))
    return scored.select("event_id", "location.*")


@query(
    "convert_types",
    f"""WITH {cte('points')}
    SELECT event_id,
      CASE WHEN event_id % 9 = 0 THEN -999 ELSE CAST(trunc("Temperature_C") AS INTEGER) END AS "Temperature_C",
      CAST(trunc("Humidity_%") AS INTEGER) AS "Humidity_%", "pressure_hPa", "wind_speed_meterSec",
      "Give_Way", "Crossing", "Traffic_Calming", "Traffic_Signal", "Railway", "Stop",
      "Amenity", "No_Exit", "Junction", lat,
      CASE WHEN event_id % 8 = 0 THEN NULL ELSE lon END AS lon
    FROM points""",
)
def convert_types(spark, sf):
    """Text fields to numbers; unreadable texts become null (a null temperature shows as -999)."""
    points = standin(spark, sf, "points")
    fields = [*point_steps.POINT_WHOLE_FIELDS, *point_steps.DECIMAL_FIELDS]
    texts = {c: F.col(f"`{c}`").cast("string") for c in fields}
    texts["Temperature_C"] = F.when(F.col("event_id") % 9 == 0, "%{[main][temp]}").otherwise(
        texts["Temperature_C"]
    )
    texts["lon"] = F.when(F.col("event_id") % 8 == 0, "east").otherwise(texts["lon"])
    converted = point_steps.convert_types(
        points.select("event_id", *[t.alias(c) for c, t in texts.items()])
    )
    return converted.fillna({"Temperature_C": -999})


CLEANED_SQL = f"""{weather_dim_sql()},
  cleaned AS (SELECT "Street", "City", "County", "State",
    CAST(round(("Temperature(F)" - 32) * (5e0 / 9e0)) AS INTEGER) AS "Temperature(C)",
    CAST(round("Humidity(%)") AS INTEGER) AS "Humidity(%)",
    CAST(round("Pressure(in)") AS INTEGER) AS "Pressure(in)",
    CAST(round("Wind_Speed(mph)") AS INTEGER) AS "Wind_Speed(mph)",
    coalesce(d.class, 'Unknown') AS "Weather_Condition",
    {', '.join(f'CAST("{f}" AS INTEGER) AS "{f}"' for f in FLAGS)}, "Sunrise_Sunset"
  FROM accidents a LEFT JOIN weather_dim d ON a."Weather_Condition" = d.raw
  WHERE {' AND '.join(f'"{c}" IS NOT NULL' for c in cleaning.REQUIRED)})"""


@query(
    "clean_conditions",
    f"""WITH {cte('accidents')}, {CLEANED_SQL} SELECT * FROM cleaned""",
)
def clean_conditions(spark, sf):
    return cleaning.clean_accidents(standin(spark, sf, "accidents"))


# ---------------------------------------------------------------- filters


@query(
    "filter_not_null",
    f"""WITH {cte('accidents')}
    SELECT "Street", "Temperature(F)", "Weather_Condition", "Traffic_Calming", "Sunrise_Sunset"
    FROM accidents WHERE {' AND '.join(f'"{c}" IS NOT NULL' for c in cleaning.REQUIRED)}""",
)
def filter_not_null(spark, sf):
    complete = relational.require_not_null(standin(spark, sf, "accidents"), cleaning.REQUIRED)
    return complete.select(
        "Street", "Temperature(F)", "Weather_Condition", "Traffic_Calming", "Sunrise_Sunset"
    )


@query(
    "filter_eq",
    """SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'""",
)
def filter_eq(spark, sf):
    kept = relational.keep_equal(load(spark, sf, "events"), "event_type", "purchase")
    return kept.select("event_id", "user_id", "value")


@query(
    "dash_recent",
    """SELECT event_id, user_id, value FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTE
      AND ts <= (SELECT max(ts) FROM events)""",
)
def dash_recent(spark, sf):
    return report.recent(load(spark, sf, "events"), "ts").select("event_id", "user_id", "value")


@query(
    "dash_bbox",
    f"""WITH {cte('scored')}
    SELECT event_id, lat, lon, danger_index FROM scored
    WHERE lat BETWEEN {MAP_BOUNDS['min_lat']}e0 AND {MAP_BOUNDS['max_lat']}e0
      AND lon BETWEEN {MAP_BOUNDS['min_lon']}e0 AND {MAP_BOUNDS['max_lon']}e0""",
)
def dash_bbox(spark, sf):
    return report.in_bounds(standin(spark, sf, "scored")).select(
        "event_id", "lat", "lon", "danger_index"
    )


_clustered = ("event_id", "lat", "lon", "danger_index")


def _by_cell(spark, sf, lon="lon"):
    """The scored points in files of neighbouring cells; ``wide`` is the longitude that counts."""
    path = scratch_path(spark, "cells")
    rows = standin(spark, sf, "scored").withColumn("wide", F.expr(lon))
    rows = rows.withColumn("cell", geo.z_cell(F.col("lat"), F.col("wide")))
    rows.repartitionByRange(8, "cell").sortWithinPartitions("cell").write.parquet(path)
    return spark.read.parquet(path)


@query(
    "dash_bbox_pruned",
    f"""WITH {cte('scored')}
    SELECT event_id, lat, lon, danger_index FROM scored
    WHERE lat BETWEEN 37.45e0 AND 37.5e0 AND lon BETWEEN 15e0 AND 15.1e0""",
)
def dash_bbox_pruned(spark, sf):
    """Points of a small rectangle; parts of files with other cells alone are not read."""
    bounds = {"min_lat": 37.45, "max_lat": 37.5, "min_lon": 15.0, "max_lon": 15.1}
    return report.in_bounds(_by_cell(spark, sf), **bounds).select(*_clustered)


@query(
    "dash_bbox_wrapped",
    f"""WITH {cte('scored')}
    SELECT event_id, lat, lon * 8 AS lon, danger_index FROM scored
    WHERE lat BETWEEN 37.4e0 AND 37.6e0 AND (lon * 12 - 180 >= 1e0 OR lon * 12 - 180 <= 0e0)""",
)
def dash_bbox_wrapped(spark, sf):
    """Points of a rectangle across 180 degrees: all but one degree of longitude."""
    rows = _by_cell(spark, sf, "lon * 12 - 180")
    found = report.in_bounds(rows, lon="wide", min_lat=37.4, max_lat=37.6, min_lon=1.0, max_lon=0.0)
    return found.select("event_id", "lat", (F.col("lon") * 8).alias("lon"), "danger_index")


# ---------------------------------------------------------------- json


@query(
    "json_encode",
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type
      || '","user_id":' || user_id || '}' AS value FROM events""",
)
def json_encode(spark, sf):
    events = load(spark, sf, "events").select("event_id", "event_type", "user_id")
    return as_messages(events, "event_id").select(
        F.col("key").cast("bigint").alias("event_id"), "value"
    )


_broken = "event_id % 101 = 0 OR event_id % 103 = 0"


def point_messages(spark, sf):
    """Point rows as messages; some are malformed, some null."""
    points = standin(spark, sf, "points")
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in points.columns]))
    value = (
        F.when(F.col("event_id") % 103 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 101 == 0, F.lit('{"way_id": 1, "highw'))
        .otherwise(text)
    )
    return points.select(value.cast("binary").alias("value"))


@query(
    "json_decode",
    f"""WITH {cte('points')}
    SELECT way_id, highway, name, CAST(trunc("Temperature_C") AS INTEGER) AS "Temperature_C",
      CAST("Humidity_%" AS INTEGER) AS "Humidity_%", "pressure_hPa", "wind_speed_meterSec",
      weather_icon, "Give_Way", "Crossing", "Traffic_Calming", "Traffic_Signal", "Railway",
      "Stop", "Amenity", "No_Exit", "Junction", lat, lon, weather_timestamp_iso8601
    FROM points WHERE NOT ({_broken})""",
)
def json_decode(spark, sf):
    """Message bytes to typed rows; broken messages are routed away first."""
    return scoring.decode_readable(point_messages(spark, sf))


@query(
    "json_broken",
    f"""SELECT CAST(count(*) AS BIGINT) AS n,
      CAST(count(*) FILTER (event_id % 103 = 0) AS BIGINT) AS n_null
    FROM events WHERE {_broken}""",
)
def json_broken(spark, sf):
    return scoring.broken(point_messages(spark, sf)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("value").isNull(), 1)).alias("n_null"),
    )


_node_sql = """documents AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, i
    FROM orders, range(4) AS r(i) WHERE i < o_orderkey % 4)"""


def flat_documents_sql(icon: str) -> str:
    return f"""WITH {_node_sql}
    SELECT o_orderkey AS way_id, o_orderpriority AS highway, 'Road ' || o_custkey AS name,
      CAST(trunc(o_orderkey % 40 - 10 + 7e-1) AS INTEGER) AS "Temperature_C",
      CAST(o_custkey % 101 AS INTEGER) AS "Humidity_%",
      1000e0 + (o_orderkey % 300) / 1e1 AS "pressure_hPa",
      (o_custkey % 90) / 1e1 AS "wind_speed_meterSec",
      CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE {icon} END AS weather_icon,
      CAST((o_orderkey + i) % 3 AS INTEGER) % 2 AS "Give_Way",
      CAST((o_orderkey + i) % 2 AS INTEGER) AS "Crossing", 1 AS "Traffic_Calming",
      CAST(i AS INTEGER) % 2 AS "Traffic_Signal",
      CAST((o_orderkey + i) % 5 AS INTEGER) % 2 AS "Railway", 0 AS "Stop",
      CAST(o_custkey % 2 AS INTEGER) AS "Amenity", 0 AS "No_Exit",
      CAST(o_custkey % 3 AS INTEGER) % 2 AS "Junction", 37e0 + i AS lat, 15e0 + i AS lon,
      CAST(epoch(o_orderdate) AS BIGINT) AS weather_timestamp,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS weather_timestamp_iso8601
    FROM documents"""


FLAT_SQL = flat_documents_sql(icon_text("o_orderkey % 11", "o_custkey"))


@query("flatten_event", FLAT_SQL)
def flatten_event(spark, sf):
    return point_steps.flatten_documents(standin(spark, sf, "documents_of_roads"))
