"""Streaming queries: files arrive, the stream takes them all and stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import emit, score
from ..schemas import ROAD_EVENT, SCORED
from ..session import scratch_path
from ..sources.streams import append_stream, as_messages, read_documents, read_messages
from ..streaming import points as point_steps
from ..streaming import scoring, weather
from .base import NODE_LAT, NODE_LON, POI_LAT, POI_LON, cte, distance_sql, icon_class_sql, icon_text, load, query, standin
from .models import STUMP_FLAG, STUMP_SQL, stump, trained
from .scalars import FLAT_SQL


def _run(df, label, **settings):
    """Run a stream to its end; returns what it wrote."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    append_stream(df, f"{path}/out", f"{path}/checkpoint", **settings).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")


def _arrived(spark, sf):
    """Nested road documents as files in a folder."""
    path = scratch_path(spark, "arrived")
    standin(spark, sf, "documents_of_roads").write.json(path)
    return path


@query("stream_flatten", FLAT_SQL)
def stream_flatten(spark, sf):
    documents = read_documents(spark, _arrived(spark, sf), ROAD_EVENT)
    return _run(point_steps.flatten_documents(documents), "flat")


@query("stream_restart", FLAT_SQL)
def stream_restart(spark, sf):
    """The stream is run, run again without news, and once more after new files arrived."""
    documents = standin(spark, sf, "documents_of_roads")
    folder = scratch_path(spark, "arriving")
    target = scratch_path(spark, "restarted")
    early = F.col("way_id") % 3 != 0

    def run():
        flat = point_steps.flatten_documents(read_documents(spark, folder, ROAD_EVENT))
        append_stream(flat, f"{target}/out", f"{target}/checkpoint").awaitTermination()
        return flat.schema

    documents.filter(early).write.mode("append").json(folder)
    run()
    run()
    documents.filter(~early).write.mode("append").json(folder)
    return spark.read.schema(run()).parquet(f"{target}/out")


@query(
    "stream_weather_join",
    f"""SELECT c_custkey AS way_id, user_id AS place, event_id AS dt, value AS temp,
      {icon_text('event_id % 11', 'user_id')} AS icon
    FROM events JOIN customer ON user_id = CAST(floor(c_custkey / 9) AS BIGINT)
    WHERE event_id % 4 <> 0""",
)
def stream_weather_join(spark, sf):
    """Weather updates as the stream, joined to static roads."""
    from .joins import _observations, weather_roads

    arrived = scratch_path(spark, "updates")
    observations = _observations(spark, sf)
    observations.write.json(arrived)
    updates = read_documents(spark, arrived, observations.schema)
    fresh = weather.refresh(updates, weather_roads(spark, sf), ["place"])
    flat = fresh.select(
        "way_id",
        "place",
        F.col("weather_info.dt").alias("dt"),
        F.col("weather_info.main.temp").alias("temp"),
        F.get("weather_info.weather", F.lit(0))["icon"].alias("icon"),
    )
    return _run(flat, "fresh")


@query(
    "stream_messages",
    f"""WITH {cte('points')}
    SELECT way_id, name, CAST(trunc("Temperature_C") AS INTEGER) AS "Temperature(C)",
      CAST(trunc("pressure_hPa" * 0.02953e0) AS INTEGER) AS "Pressure(in)",
      CASE WHEN substr(weather_icon, 3, 1) = 'd' THEN 'Day' ELSE 'Night' END AS "Sunrise_Sunset",
      lat, lon FROM points""",
)
def stream_messages(spark, sf):
    """Messages in, typed and derived rows out: the scoring stream up to the model."""
    folder = scratch_path(spark, "messages")
    as_messages(standin(spark, sf, "points")).write.text(folder)
    messages = read_messages(spark, "text", folder)
    derived = scoring.derive_conditions(scoring.decode_readable(messages))
    return _run(
        derived.select("way_id", "name", "Temperature(C)", "Pressure(in)", "Sunrise_Sunset", "lat", "lon"),
        "derived",
    )


def _scored_stream(spark, sf, fitted):
    """The scored points that the streams of the score job append."""
    folder, path = scratch_path(spark, "messages"), scratch_path(spark, "score")
    as_messages(standin(spark, sf, "points")).write.text(folder)
    running = score.start(
        read_messages(spark, "text", folder), fitted, f"{path}/out", f"{path}/checkpoint", "reject"
    )
    for stream in running:
        stream.awaitTermination()
    scored = spark.read.parquet(f"{path}/out/scored").drop("event_date")
    return scored.select(*[F.col(f"`{f.name}`") for f in SCORED.fields if f.name != "location"],
                         F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"))


@query("stream_score")
def stream_score(spark, sf):
    """Messages to scored points with the fitted model; unscoreable rows go aside."""
    return _scored_stream(spark, sf, trained(spark, sf)[1])


@query(
    "stream_stump_score",
    f"""WITH {cte('accidents', 'roads', 'points')}, {STUMP_SQL}
    SELECT p.way_id, p.name, p.lat, p.lon, mean AS danger_index
    FROM points p JOIN means ON flag = p."{STUMP_FLAG}"
    WHERE p.highway IN (SELECT highway FROM counts)
      AND {icon_class_sql('weather_icon')} IN (SELECT "Weather_Condition" FROM counts)
      AND CASE WHEN substr(weather_icon, 3, 1) = 'd' THEN 'Day' ELSE 'Night' END
        IN (SELECT "Sunrise_Sunset" FROM counts)""",
)
def stream_stump_score(spark, sf):
    """The score job with a one-split model, whose predictions are two group means."""
    scored = _scored_stream(spark, sf, stump(spark, sf)[1])
    return scored.select("way_id", "name", "lat", "lon", "danger_index")


_UNUSABLE = "p.event_id % 50 = 0"  # messages that are cut off


@query(
    "stream_score_outputs",
    f"""WITH {cte('accidents', 'roads', 'points')}, {STUMP_SQL},
    kinds AS (SELECT way_id, lat, CASE WHEN {_UNUSABLE} THEN 'broken'
        WHEN p.highway IN (SELECT highway FROM counts)
          AND {icon_class_sql('weather_icon')} IN (SELECT "Weather_Condition" FROM counts)
          AND CASE WHEN substr(weather_icon, 3, 1) = 'd' THEN 'Day' ELSE 'Night' END
            IN (SELECT "Sunrise_Sunset" FROM counts) THEN 'scored' ELSE 'rejected' END AS kind FROM points p)
    SELECT kind, CASE WHEN kind <> 'broken' THEN way_id END AS way_id, count(*) AS n,
      sum(CASE WHEN kind <> 'broken' THEN CAST(floor(lat * 1000) AS BIGINT) ELSE 0 END)::BIGINT AS lats
    FROM kinds GROUP BY ALL""",
)
def stream_score_outputs(spark, sf):
    """The three outputs of the one scoring stream, run in several batches, and run again."""
    folder, path = scratch_path(spark, "messages"), scratch_path(spark, "score")
    points = standin(spark, sf, "points")
    value = F.to_json(F.struct(*points.columns))
    text = F.when(F.col("event_id") % 50 == 0, F.substring(value, 1, 25)).otherwise(value)
    points.repartition(3, "event_id").select(text.alias("value")).write.text(folder)
    fitted = stump(spark, sf)[1]
    for _ in range(2):
        messages = read_messages(spark, "text", folder, maxFilesPerTrigger=1)
        for stream in score.start(messages, fitted, f"{path}/out", f"{path}/checkpoint", "reject"):
            stream.awaitTermination()
    kinds = None
    for kind, lat in (("scored", F.col("location.lat")), ("rejected", F.col("lat")), ("broken", None)):
        rows = spark.read.parquet(f"{path}/out/{kind}")
        way = F.lit(None).cast("long") if lat is None else F.col("way_id")
        lats = F.lit(0).cast("long") if lat is None else F.floor(lat * 1000)
        part = rows.groupBy(F.lit(kind).alias("kind"), way.alias("way_id")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(lats).alias("lats")
        )
        kinds = part if kinds is None else kinds.unionByName(part)
    return kinds


_HEARD_M = 1_500.0
_STATION = "(p_partkey - p_partkey % 2)"  # a station is heard of twice, in two batches
_station_lat, _station_lon = (e.replace("p_partkey", _STATION) for e in (POI_LAT, POI_LON))


@query(
    "stream_nearest_weather",
    f"""WITH nodes AS (SELECT c_custkey AS way_id, {NODE_LAT} AS lat, {NODE_LON} AS lon FROM customer),
    updates AS (SELECT {_station_lat} AS lat, {_station_lon} AS lon, p_partkey AS dt, p_partkey % 3 AS b FROM part),
    stations AS (SELECT k.b AS batch, lat, lon, max(dt) AS dt, arg_max(u.b, dt) AS heard
      FROM updates u JOIN (VALUES (0), (1), (2)) k(b) ON u.b <= k.b GROUP BY k.b, lat, lon),
    pairs AS (SELECT n.way_id, s.batch, s.dt, s.heard, {distance_sql('n', 's')} AS far
      FROM nodes n JOIN stations s ON {distance_sql('n', 's')} <= {_HEARD_M}e0),
    nearest AS (SELECT way_id, batch, arg_min(dt, (far, -dt)) AS dt, arg_min(heard, (far, -dt)) AS heard
      FROM pairs GROUP BY way_id, batch)
    SELECT way_id, CAST(dt AS INTEGER) AS temp FROM nearest WHERE heard = batch""",
)
def stream_nearest_weather(spark, sf):
    """Roads hear from their nearest station in each batch that it reports in; run again in between."""
    arrived, path = scratch_path(spark, "updates"), scratch_path(spark, "live")
    part = load(spark, sf, "part")
    info = F.struct(
        F.struct(F.col("p_partkey").cast("double").alias("temp")).alias("main"),
        F.array(F.struct(F.lit("01d").alias("icon"))).alias("weather"),
        F.col("p_partkey").alias("dt"),
    )
    updates = part.select(F.expr(_station_lat).alias("lat"), F.expr(_station_lon).alias("lon"), info.alias("weather_info"))
    place = [F.expr(NODE_LAT).alias("first_lat"), F.expr(NODE_LON).alias("first_lon")]
    node = "transform(array(0), i -> named_struct({flags}, 'lat', 37e0, 'lon', 15e0))"
    flags = ", ".join(f"'{f.name}', 0" for f in ROAD_EVENT["nodes_info"].dataType.elementType.fields if f.name not in ("lat", "lon"))
    documents = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("way_id"), F.lit(0).alias("part"), F.lit("x").alias("highway"), F.lit("n").alias("name"),
        F.expr(node.format(flags=flags)).alias("nodes_info"), *place,
    )
    for batch in range(3):
        updates.filter(F.col("weather_info.dt") % 3 == batch).coalesce(1).write.mode("append").json(arrived)
        emit.start_live(
            read_documents(spark, arrived, emit.UPDATE), documents, f"{path}/out", f"{path}/checkpoint",
            every_seconds=None, radius_m=_HEARD_M,
        ).awaitTermination()
    sent = scoring.decode_readable(spark.read.text(f"{path}/out"))
    return sent.select("way_id", F.col("Temperature_C").alias("temp"))
