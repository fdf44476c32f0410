"""Query registry and stand-in tables.

A stand-in gives a star-schema table the columns of a road-risk table. Its expressions are
plain SQL that both engines evaluate, or a (Spark, DuckDB) pair where syntax differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import EARTH_RADIUS_M, ICON_CLASSES, WEATHER_CLASSES
from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its DuckDB twin."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _city(key: str, size: int) -> str:
    return f"floor({key} / {size})"


def _lat(key: str, size: int, factor: int, modulus: int) -> str:
    return (
        f"37e0 + ({_city(key, size)} % 500) * 6e-2"
        f" + (({key} * {factor}) % {modulus}) / {modulus}e0 * 4e-2"
    )


def _lon(key: str, size: int, factor: int, modulus: int) -> str:
    return (
        f"15e0 + (floor({_city(key, size)} / 500) % 2000) * 6e-2"
        f" + (({key} * {factor}) % {modulus}) / {modulus}e0 * 4e-2"
    )


def _div(key: str, by: int) -> str:
    return f"CAST(floor({key} / {by}) AS BIGINT)"


_icons = list(ICON_CLASSES)
_icon_case = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate([*_icons, "99"]))


def icon_text(number: str, part: str) -> str:
    return f"(CASE {number} {_icon_case} END) || (CASE WHEN {part} % 2 = 0 THEN 'd' ELSE 'n' END)"


NODE_LAT = _lat("c_custkey", 300, 7919, 4001)
NODE_LON = _lon("c_custkey", 300, 104729, 4003)
POI_LAT = _lat("p_partkey", 400, 6101, 3989)
POI_LON = _lon("p_partkey", 400, 3571, 3967)

# (spark, duckdb) map literal of tags by p_size
_poi_tags = {
    0: {"highway": "crossing"},
    1: {"highway": "give_way"},
    2: {"railway": "level_crossing"},
    3: {"highway": "stop"},
    4: {"traffic_calming": "bump"},
    5: {"highway": "traffic_signals"},
    6: {"amenity": "cafe", "highway": "crossing"},
    7: {"noexit": "no"},
    8: {"junction": "yes", "highway": "street_lamp"},
    9: {"shop": "bakery"},
}
_tags_spark = "CASE p_size % 10 " + " ".join(
    f"WHEN {i} THEN map({', '.join(repr(x) for kv in tags.items() for x in kv)})"
    for i, tags in _poi_tags.items()
) + " END"
_tags_duck = "CASE p_size % 10 " + " ".join(
    f"WHEN {i} THEN MAP {{{', '.join(f'{k!r}: {v!r}' for k, v in tags.items())}}}"
    for i, tags in _poi_tags.items()
) + " END"

def _documents(key: str, other: str, highway: str, dt: str) -> dict[str, tuple[str, str]]:
    points = f"filter(sequence(0, 3), i -> i < {key} % 4)"
    columns = {
        "way_id": key,
        "highway": highway,
        "name": f"'Road ' || {other}",
        "lista_coppie": f"transform({points}, i -> array(37e0 + i, 15e0 + i))",
        "nodes_info": f"transform({points}, i -> named_struct("
        f"'Crossing', CAST(({key} + i) % 2 AS INT),"
        f"'Give_Way', CAST(({key} + i) % 3 AS INT) % 2,"
        f"'Railway', CAST(({key} + i) % 5 AS INT) % 2,"
        "'Stop', 0, 'Traffic_Calming', 1, 'Traffic_Signal', CAST(i AS INT) % 2,"
        f"'Amenity', CAST({other} % 2 AS INT), 'No_Exit', 0,"
        f"'Junction', CAST({other} % 3 AS INT) % 2,"
        "'lat', 37e0 + i, 'lon', 15e0 + i))",
        "weather_info": f"named_struct('main', named_struct('temp', {key} % 40 - 10 + 7e-1,"
        f" 'humidity', CAST({other} % 101 AS DOUBLE),"
        f" 'pressure', 1000e0 + ({key} % 300) / 1e1),"
        f" 'wind', named_struct('speed', ({other} % 90) / 1e1),"
        f" 'weather', CASE WHEN {key} % 13 = 0 THEN NULL WHEN {key} % 17 = 0"
        " THEN CAST(array() AS ARRAY<STRUCT<icon: STRING>>) ELSE"
        f" array(named_struct('icon', {icon_text(f'{key} % 11', other)})) END,"
        f" 'dt', {dt})",
    }
    return {name: (expression, "NULL") for name, expression in columns.items()}


STANDINS: dict[str, tuple[str, dict[str, str | tuple[str, str]]]] = {
    "accidents": (
        "lineitem",
        {
            "Street": "CASE WHEN l_suppkey % 41 = 40 THEN NULL"
            f" ELSE 'Street ' || {_div('l_partkey', 4)} END",
            "City": f"'City ' || {_div('l_partkey', 40)}",
            "County": f"'County ' || {_div('l_partkey', 400)}",
            "State": "'State ' || (l_partkey % 2)",
            "Temperature(F)": "CASE WHEN l_suppkey % 29 = 3 THEN NULL"
            " ELSE floor(l_quantity / 17) * 9e0 + 14.9e0 END",
            "Humidity(%)": "floor(l_discount * 12) * 20e0 + 15.5e0",
            "Pressure(in)": "floor(l_tax * 15) * 5e-1 + 29e0",
            "Wind_Speed(mph)": "(l_linenumber % 2) * 3.5e0",
            "Weather_Condition": "CASE l_suppkey % 10 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Fair'"
            " WHEN 2 THEN 'Overcast' WHEN 3 THEN 'Rain and Sleet' WHEN 4 THEN 'Light Rain'"
            " WHEN 5 THEN 'T-Storm' WHEN 6 THEN 'Heavy Snow' WHEN 7 THEN 'Haze'"
            " WHEN 8 THEN 'Meteor Shower' END",
            "Amenity": "l_returnflag = 'A'",
            "Crossing": "l_linestatus = 'O'",
            "Give_Way": "l_partkey % 5 = 0",
            "Junction": "l_returnflag = 'R'",
            "No_Exit": "l_partkey % 11 = 0",
            "Railway": "l_suppkey % 13 = 0",
            "Stop": "l_suppkey % 7 = 0",
            "Traffic_Calming": "CASE WHEN l_orderkey % 97 = 5 THEN NULL ELSE l_partkey % 17 = 0 END",
            "Traffic_Signal": "l_partkey % 3 = 0",
            "Sunrise_Sunset": "CASE WHEN l_orderkey % 89 = 1 THEN NULL"
            " WHEN l_orderkey % 3 = 0 THEN 'Night' ELSE 'Day' END",
        },
    ),
    "roads": (
        "part",
        {
            "input_street": f"'Street ' || {_div('p_partkey', 4)}",
            "input_city": f"'City ' || {_div('p_partkey', 40)}",
            "input_county": f"'County ' || {_div('p_partkey', 400)}",
            "input_state": "'State ' || (p_partkey % 2)",
            "highway": "p_type",
        },
    ),
    "ways": (
        "part",
        {
            "way_id": "p_partkey",
            "name": "CASE WHEN p_size % 17 = 0 THEN NULL ELSE p_name END",
            "highway": "p_type",
            "nodes": (
                "transform(sequence(0, p_size % 4), i ->"
                " CAST(floor(p_partkey * 3 / 4) AS BIGINT) + i * 7)",
                "[CAST(floor(p_partkey * 3 / 4) AS BIGINT) + i * 7 FOR i IN range(p_size % 4 + 1)]",
            ),
        },
    ),
    "nodes": ("customer", {"node_id": "c_custkey", "lat": NODE_LAT, "lon": NODE_LON}),
    "pois": (
        "part",
        {"poi_id": "p_partkey", "lat": POI_LAT, "lon": POI_LON, "tags": (_tags_spark, _tags_duck)},
    ),
    "gazetteer": (
        "customer",
        {
            "address": f"'Street ' || {_div('c_custkey', 2)} || ', City '"
            f" || ({_div('c_custkey', 2)} % 5)",
            "rank": "CAST((c_custkey + 1) % 2 AS INT)",
            "lat": NODE_LAT,
            "lon": NODE_LON,
        },
    ),
    "address_lines": (
        "orders",
        {
            "line": "CASE WHEN o_orderkey % 50 = 49 THEN 'Street without mark ' || o_orderkey"
            f" ELSE '  Street ' || {_div('o_custkey', 2)} || '  # ' || (CASE WHEN"
            " o_orderkey % 7 = 0 THEN 'Nowhere' ELSE 'City ' ||"
            f" ({_div('o_custkey', 2)} % 5) END) || ' ' END"
        },
    ),
    # street texts that resemble way names, placed where map features are
    "street_places": (
        "part",
        {
            "address_id": "p_partkey",
            "street": "CASE p_size % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || ' st.'"
            " WHEN 2 THEN substr(p_name, 3) ELSE 'via ' || p_name END",
            "lat": POI_LAT,
            "lon": POI_LON,
        },
    ),
    "points": (
        "events",
        {
            "event_id": "event_id",
            "way_id": "user_id",
            "highway": "CASE user_id % 6 WHEN 0 THEN 'STANDARD' WHEN 1 THEN 'SMALL'"
            " WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'ECONOMY' WHEN 4 THEN 'PROMO' ELSE 'LARGE' END",
            "name": "CASE WHEN user_id % 23 = 0 THEN NULL ELSE 'Road ' || user_id END",
            "Temperature_C": "(event_id % 41) - 10 + 7e-1 * (event_id % 2)",
            "Humidity_%": "CAST(event_id % 101 AS DOUBLE)",
            "pressure_hPa": "1000e0 + (event_id % 300) / 1e1",
            "wind_speed_meterSec": "(user_id % 90) / 1e1",
            "weather_icon": icon_text("event_id % 11", "user_id"),
            "Give_Way": "CAST(event_id % 2 AS INT)",
            "Crossing": "CAST(user_id % 2 AS INT)",
            "Traffic_Calming": "CAST(event_id % 3 AS INT) % 2",
            "Traffic_Signal": "CAST(user_id % 3 AS INT) % 2",
            "Railway": "CAST(event_id % 5 AS INT) % 2",
            "Stop": "CAST(user_id % 5 AS INT) % 2",
            "Amenity": "CAST(event_id % 7 AS INT) % 2",
            "No_Exit": "CAST(user_id % 7 AS INT) % 2",
            "Junction": "CAST((event_id + user_id) % 2 AS INT)",
            "lat": "37.4e0 + ((event_id * 7919) % 10007) / 10007e0 * 3e-1",
            "lon": "14.9e0 + ((event_id * 104729) % 10009) / 10009e0 * 4e-1",
            "weather_timestamp_iso8601": (
                "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
                "strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%gZ')",
            ),
        },
    ),
    "scored": (
        "events",
        {
            "event_id": "event_id",
            "name": "CASE WHEN user_id % 23 = 0 THEN NULL ELSE 'Road ' || user_id END",
            "danger_index": "value / 1e2",
            "lat": "37.4e0 + ((event_id * 7919) % 10007) / 10007e0 * 3e-1",
            "lon": "14.9e0 + ((event_id * 104729) % 10009) / 10009e0 * 4e-1",
            "ts": "ts",
        },
    ),
    # one nested document per order or supplier; DuckDB twins rebuild the flat fields
    "documents_of_roads": (
        "orders",
        _documents("o_orderkey", "o_custkey", "o_orderpriority", "unix_seconds(CAST(o_orderdate AS TIMESTAMP))"),
    ),
    "documents_of_suppliers": (
        "supplier",
        _documents("s_suppkey", "s_nationkey", "s_name", "s_suppkey * 1000"),
    ),
}


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in table in Spark."""
    table, columns = STANDINS[name]
    exprs = {c: e[0] if isinstance(e, tuple) else e for c, e in columns.items()}
    return load(spark, sf_dir, table).select(*[F.expr(e).alias(c) for c, e in exprs.items()])


def cte(*names: str) -> str:
    """The same stand-ins as DuckDB common table expressions (after ``WITH``)."""
    parts = []
    for name in names:
        table, columns = STANDINS[name]
        exprs = {c: e[1] if isinstance(e, tuple) else e for c, e in columns.items()}
        fields = ", ".join(f'{e} AS "{c}"' for c, e in exprs.items())
        parts.append(f"{name} AS (SELECT {fields} FROM {table})")
    return ", ".join(parts)


def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def weather_dim_sql() -> str:
    """CTE weather_dim(raw, class): the first class in list order per raw text."""
    rows, place = [], 0
    for name, texts in WEATHER_CLASSES.items():
        for text in texts:
            rows.append(f"({sql_text(text)}, {sql_text(name)}, {place})")
            place += 1
    return (
        "weather_dim AS (SELECT raw, arg_min(class, place) AS class FROM (VALUES "
        + ", ".join(rows)
        + ") AS t(raw, class, place) GROUP BY raw)"
    )


def icon_class_sql(icon: str) -> str:
    cases = " ".join(
        f"WHEN {icon} IN ('{n}d', '{n}n') THEN '{c}'" for n, c in ICON_CLASSES.items()
    )
    return f"CASE {cases} ELSE 'unknown' END"


def distance_sql(a: str, b: str) -> str:
    return (
        f"2 * {EARTH_RADIUS_M} * asin(sqrt(least(1e0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2)"
        f" + cos(radians({a}.lat)) * cos(radians({b}.lat))"
        f" * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"
    )


def segment_distance_sql(p: str, s: str) -> str:
    """Distance of a place from a segment (lat1, lon1, lat2, lon2), in two lateral steps.

    To be used as ``{p} JOIN {s} ON ({segment_distance_sql(p, s)}) <= radius``.
    """

    def vector(lat: str, lon: str) -> list[str]:
        return [f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))"]

    a, b, c = vector(f"{s}.lat1", f"{s}.lon1"), vector(f"{s}.lat2", f"{s}.lon2"), vector(f"{p}.lat", f"{p}.lon")
    minus = lambda u, v: [f"({x} - {y})" for x, y in zip(u, v)]
    dot = lambda u, v: "(" + " + ".join(f"({x}) * ({y})" for x, y in zip(u, v)) + ")"

    def cross(u: list[str], v: list[str]) -> list[str]:
        turns = [(1, 2), (2, 0), (0, 1)]
        return [f"(({u[i]}) * ({v[j]}) - ({u[j]}) * ({v[i]}))" for i, j in turns]

    normal = cross(a, minus(b, a))
    size = f"sqrt({dot(normal, normal)})"
    beside = f"{dot(cross(normal, a), minus(c, a))} > 0 AND {dot(cross(b, normal), minus(c, b))} > 0"
    arc = f"{EARTH_RADIUS_M} * asin(least(1e0, abs({dot(normal, minus(c, a))}) / {size}))"
    ends = [
        f"2 * {EARTH_RADIUS_M} * asin(sqrt(least(1e0, pow(sin(radians({s}.lat{i} - {p}.lat) / 2), 2)"
        f" + cos(radians({p}.lat)) * cos(radians({s}.lat{i})) * pow(sin(radians({s}.lon{i} - {p}.lon) / 2), 2))))"
        for i in (1, 2)
    ]
    return f"CASE WHEN {size} > 1e-15 AND {beside} THEN {arc} ELSE least({ends[0]}, {ends[1]}) END"
