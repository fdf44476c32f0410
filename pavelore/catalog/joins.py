"""Joins, lookups, set operations and the scenario grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import strings
from ..operators import geocoding, relational, roads, scenario
from .base import cte, distance_sql, icon_text, load, query, standin

_joined = 'a."Street", a."City", a."County", a."State", "Temperature(F)", "Humidity(%)"'


@query(
    "join_multikey",
    f"""WITH {cte('accidents', 'roads')}
    SELECT {_joined}, highway FROM accidents a JOIN roads r ON a."Street" = r.input_street
      AND a."City" = r.input_city AND a."County" = r.input_county AND a."State" = r.input_state""",
)
def join_multikey(spark, sf):
    accidents = standin(spark, sf, "accidents").select(
        "Street", "City", "County", "State", "Temperature(F)", "Humidity(%)"
    )
    return roads.join_roads(accidents, standin(spark, sf, "roads"))


@query(
    "way_nodes",
    f"""WITH {cte('ways', 'nodes')},
    steps AS (SELECT way_id, unnest(nodes) AS node_id, generate_subscripts(nodes, 1) - 1 AS pos
      FROM ways)
    SELECT way_id, CAST(pos AS INTEGER) AS pos, node_id, lat, lon FROM steps JOIN nodes USING (node_id)""",
)
def way_nodes(spark, sf):
    return roads.way_nodes(standin(spark, sf, "ways"), standin(spark, sf, "nodes"))


@query(
    "way_attributes",
    """SELECT p_partkey AS way_id, p_type AS highway, p_name AS name FROM part""",
)
def way_attributes(spark, sf):
    """Id, road type and name of a way from its tag map."""
    tags = F.create_map(F.lit("highway"), F.col("p_type"), F.lit("name"), F.col("p_name"))
    return roads.way_attributes(load(spark, sf, "part").select(F.col("p_partkey").alias("id"), tags.alias("tags")))


@query(
    "first_node",
    f"""WITH {cte('ways', 'nodes')},
    steps AS (SELECT way_id, unnest(nodes) AS node_id, generate_subscripts(nodes, 1) - 1 AS pos
      FROM ways)
    SELECT way_id, CAST(pos AS INTEGER) AS pos, node_id, lat, lon FROM steps JOIN nodes USING (node_id)
    QUALIFY row_number() OVER (PARTITION BY way_id ORDER BY pos, node_id) = 1""",
)
def first_node(spark, sf):
    return roads.first_node(roads.way_nodes(standin(spark, sf, "ways"), standin(spark, sf, "nodes")))


def _addresses(spark, sf):
    line = F.col("line")
    return (
        standin(spark, sf, "address_lines")
        .filter(line.contains("#"))
        .select(strings.street_of(line).alias("street"), strings.full_address(line).alias("address"))
    )


_addresses_sql = """addresses AS (SELECT trim(split_part(line, '#', 1)) AS street,
    trim(split_part(line, '#', 1)) || ', ' || trim(split_part(line, '#', 2)) AS address
    FROM address_lines WHERE line LIKE '%#%')"""


@query(
    "geocode_lookup",
    f"""WITH {cte('address_lines', 'gazetteer')}, {_addresses_sql},
    best AS (SELECT address, lat, lon FROM gazetteer
      QUALIFY row_number() OVER (PARTITION BY address ORDER BY rank, lat, lon) = 1)
    SELECT street, a.address, lat, lon FROM addresses a JOIN best USING (address)""",
)
def geocode_lookup(spark, sf):
    return roads.geocode(_addresses(spark, sf), standin(spark, sf, "gazetteer"))


_asked = f"""CASE o_orderkey % 6 WHEN 0 THEN 'city ' || (k % 5) || ',  st. ' || k
      WHEN 1 THEN 'STREET ' || k || ' - CITY ' || (k % 5) WHEN 2 THEN 'Str ' || k || ', City ' || (k % 5) || ', 2nd floor'
      WHEN 3 THEN 'street ' || k WHEN 4 THEN 'Nowhere place ' || o_orderkey ELSE 'city ' || (k % 5) END"""
_short = ", ".join(f"('{a}', '{b}')" for a, b in geocoding.ABBREVIATIONS.items())


def _words_sql(text: str, kind: str) -> str:
    """CTEs: the distinct words of each text of a kind, abbreviations written out."""
    return f"""{kind}_parts AS (SELECT text, unnest(string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')) AS w
      FROM (SELECT DISTINCT {text})),
    {kind}_words AS (SELECT DISTINCT text, coalesce(long, w) AS word FROM {kind}_parts LEFT JOIN short ON w = abbr WHERE w <> '')"""


@query(
    "geocode_text",
    f"""WITH {cte('gazetteer')}, short(abbr, long) AS (VALUES {_short}),
    asked AS (SELECT o_orderkey, {_asked} AS address FROM (SELECT *, CAST(floor(o_custkey / 2) AS BIGINT) AS k FROM orders)),
    {_words_sql('address AS text FROM asked', 'a')}, {_words_sql('address AS text FROM gazetteer', 'g')},
    n AS (SELECT count(DISTINCT address)::DOUBLE AS n FROM gazetteer),
    df AS (SELECT word, count(*) AS df FROM g_words GROUP BY word),
    weighed AS (SELECT text, a.word, CAST(round(1000e0 * ln(1e0 + n / coalesce(df, 1))) AS BIGINT) AS weight
      FROM n, a_words a LEFT JOIN df USING (word)),
    totals AS (SELECT text, sum(weight)::BIGINT AS total FROM weighed GROUP BY text),
    shared AS (SELECT w.text, g.text AS found, sum(weight)::BIGINT AS shared
      FROM weighed w JOIN g_words g USING (word) GROUP BY ALL),
    best AS (SELECT address AS found, rank, lat, lon FROM gazetteer
      QUALIFY row_number() OVER (PARTITION BY address ORDER BY rank, lat, lon) = 1),
    chosen AS (SELECT text, found, shared / total AS coverage, lat, lon FROM shared JOIN totals USING (text) JOIN best USING (found)
      WHERE shared * 100 >= total * 60
      QUALIFY row_number() OVER (PARTITION BY text ORDER BY shared DESC, rank, found) = 1)
    SELECT o_orderkey, address, found, coverage, lat, lon FROM asked JOIN chosen ON address = text""",
)
def geocode_text(spark, sf):
    """Free address texts: other order of words, abbreviations, further or missing words, ties."""
    orders = load(spark, sf, "orders").withColumn("k", F.floor(F.col("o_custkey") / 2).cast("long"))
    asked = orders.select("o_orderkey", F.expr(_asked).alias("address"))
    found = geocoding.geocode_text(asked, standin(spark, sf, "gazetteer"))
    return found.select("o_orderkey", "address", "found", "coverage", "lat", "lon")


@query(
    "rejects",
    f"""WITH {cte('address_lines', 'gazetteer')}, {_addresses_sql}
    SELECT street, address, 'address not found' AS reason FROM addresses
    WHERE address NOT IN (SELECT address FROM gazetteer)""",
)
def rejects(spark, sf):
    addresses, gazetteer = _addresses(spark, sf), standin(spark, sf, "gazetteer")
    return relational.rejects(addresses, gazetteer, ["address"], "address not found")


@query(
    "union_all",
    """SELECT event_id, value FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, value FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, value FROM events""",
)
def union_all(spark, sf):
    events = load(spark, sf, "events").select("event_type", "event_id", "value")
    parts = [relational.keep_equal(events, "event_type", t) for t in ("click", "error")]
    return relational.append(*parts, events).select("event_id", "value")


@query(
    "first_per_group",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey, l_suppkey) = 1""",
)
def first_per_group(spark, sf):
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    order = [F.col("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey")]
    return relational.first_per_group(rows, ["l_orderkey"], order)


def _observations(spark, sf):
    """Weather per place: one observation per event, some without a weather list."""
    icon = F.expr(icon_text("event_id % 11", "user_id"))
    weather = F.when(F.col("event_id") % 4 == 0, F.array().cast("array<struct<icon:string>>")).otherwise(
        F.array(F.struct(icon.alias("icon")))
    )
    return load(spark, sf, "events").select(
        F.col("user_id").alias("place"),
        F.struct(
            F.struct(
                F.col("value").alias("temp"),
                (F.col("event_id") % 101).cast("double").alias("humidity"),
                (F.lit(1000.0) + F.col("event_id") % 300 / F.lit(10.0)).alias("pressure"),
            ).alias("main"),
            F.struct((F.col("user_id") % 90 / F.lit(10.0)).alias("speed")).alias("wind"),
            weather.alias("weather"),
            F.col("event_id").alias("dt"),
        ).alias("weather_info"),
    )


def weather_roads(spark, sf):
    return load(spark, sf, "customer").select(
        F.col("c_custkey").alias("way_id"),
        F.floor(F.col("c_custkey") / 9).cast("long").alias("place"),
    )


@query(
    "weather_enrich",
    f"""WITH newest AS (SELECT user_id AS place, max(event_id) AS event_id FROM events
      WHERE event_id % 4 <> 0 GROUP BY user_id)
    SELECT c_custkey AS way_id, n.place, e.value AS temp, CAST(e.event_id % 101 AS DOUBLE) AS humidity,
      {icon_text('e.event_id % 11', 'e.user_id')} AS icon, e.event_id AS dt
    FROM customer c JOIN newest n ON n.place = CAST(floor(c_custkey / 9) AS BIGINT)
    JOIN events e ON e.event_id = n.event_id""",
)
def weather_enrich(spark, sf):
    enriched = roads.attach_weather(weather_roads(spark, sf), _observations(spark, sf), ["place"])
    return enriched.select(
        "way_id",
        "place",
        F.col("weather_info.main.temp").alias("temp"),
        F.col("weather_info.main.humidity").alias("humidity"),
        F.col("weather_info.weather")[0]["icon"].alias("icon"),
        F.col("weather_info.dt").alias("dt"),
    )


NEAREST_M = 2_000.0  # of the stand-in roads and observations


@query(
    "weather_nearest",
    f"""WITH {cte('nodes', 'pois')},
    near AS (SELECT n.node_id, p.poi_id, {distance_sql('n', 'p')} AS far FROM nodes n
      JOIN pois p ON p.poi_id % 4 <> 0 AND {distance_sql('n', 'p')} <= {NEAREST_M}e0)
    SELECT node_id AS way_id, arg_min(poi_id, (far, -poi_id)) AS dt FROM near GROUP BY node_id""",
)
def weather_nearest(spark, sf):
    """Roads with the nearest observation, also across cell borders; by brute force in SQL."""
    here = standin(spark, sf, "nodes").select(
        F.col("node_id").alias("way_id"), F.col("lat").alias("first_lat"), F.col("lon").alias("first_lon")
    )
    listed = F.when(F.col("poi_id") % 4 != 0, F.array(F.struct(F.lit("01d").alias("icon"))))
    info = F.struct(listed.alias("weather"), F.col("poi_id").alias("dt"))
    seen = standin(spark, sf, "pois").select("lat", "lon", info.alias("weather_info"))
    found = roads.nearest_weather(here, seen, NEAREST_M)
    return found.select("way_id", F.col("weather_info.dt").alias("dt"))


_grid = """(SELECT * FROM (VALUES (30), (40), (60)) h(humidity), (VALUES (-10), (20), (30)) t(temp),
    (VALUES ('01d'), ('02d'), ('03d'), ('04d'), ('09d'), ('10d'), ('11d'), ('13d'), ('50d'),
      ('01n'), ('02n'), ('03n'), ('04n'), ('09n'), ('10n'), ('11n'), ('13n'), ('50n')) i(icon),
    (VALUES (1), (8)) w(speed), (VALUES (1010), (1020)) p(pressure))"""


@query(
    "scenario_cross",
    f"""SELECT p_partkey AS way_id, humidity, temp, icon, speed, pressure FROM part, {_grid} AS g""",
)
def scenario_cross(spark, sf):
    """Every road under each of the 648 weather settings."""
    return scenario.scenario_rows(load(spark, sf, "part").select(F.col("p_partkey").alias("way_id")))


@query(
    "scenario_events",
    f"""WITH documents AS (SELECT *, s_suppkey % 13 = 0 OR s_suppkey % 17 = 0 AS bare FROM supplier)
    SELECT g.icon, g.temp::DOUBLE AS temp, g.pressure::DOUBLE AS pressure,
      CAST(count(*) FILTER (NOT bare) AS BIGINT) AS with_icon, CAST(count(*) AS BIGINT) AS n,
      CAST(sum(s_suppkey) AS BIGINT) AS way_sum,
      CAST(sum(humidity * speed) AS DOUBLE) AS mixed
    FROM documents, {_grid} AS g GROUP BY ALL""",
)
def scenario_events(spark, sf):
    """Nested documents under every setting, summed per icon, temperature and pressure.

    The first listed icon is overwritten; a document without a weather list keeps none.
    """
    documents = standin(spark, sf, "documents_of_suppliers")
    settings = scenario.scenario_rows(documents).withColumn(
        "weather_info", scenario.replaced_weather()
    )
    listed = F.get("weather_info.weather", F.lit(0))["icon"]
    main = "weather_info.main"
    return settings.groupBy(
        "icon", F.col(f"{main}.temp").alias("temp"), F.col(f"{main}.pressure").alias("pressure")
    ).agg(
        F.count(F.when(listed == F.col("icon"), 1)).alias("with_icon"),
        F.count(F.lit(1)).alias("n"),
        F.sum("way_id").alias("way_sum"),
        F.sum(F.col(f"{main}.humidity") * F.col("weather_info.wind.speed")).alias("mixed"),
    )
