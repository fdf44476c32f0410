"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.labels import count_conditions
from ..operators.cleaning import clean_accidents
from ..schemas import ACCIDENTS, ROAD_EVENT
from ..session import scratch_path
from ..sources import files
from .base import cte, load, query, standin
from .scalars import CLEANED_SQL


@query("src_csv", f"WITH {cte('accidents')} SELECT * FROM accidents")
def src_csv(spark, sf):
    """Accident CSV with a declared schema."""
    path = scratch_path(spark, "accidents")
    files.write_csv(standin(spark, sf, "accidents"), path, packed=True)
    return files.read_csv(spark, path, ACCIDENTS)


# The columns of the public accident file, in its order.
ACCIDENT_FILE = [
    "ID", "Source", "Severity", "Start_Time", "End_Time", "Start_Lat", "Start_Lng", "End_Lat", "End_Lng",
    "Distance(mi)", "Description", "Street", "City", "County", "State", "Zipcode", "Country", "Timezone",
    "Airport_Code", "Weather_Timestamp", "Temperature(F)", "Wind_Chill(F)", "Humidity(%)", "Pressure(in)",
    "Visibility(mi)", "Wind_Direction", "Wind_Speed(mph)", "Precipitation(in)", "Weather_Condition", "Amenity",
    "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout", "Station", "Stop",
    "Traffic_Calming", "Traffic_Signal", "Turning_Loop", "Sunrise_Sunset", "Civil_Twilight",
    "Nautical_Twilight", "Astronomical_Twilight",
]


def wide(accidents):
    """Accidents in the layout of the public file; columns that no job uses hold some text."""
    have = set(accidents.columns)
    filler = F.concat(F.lit('say "'), F.coalesce("City", F.lit("")), F.lit('", then'))
    return accidents.select(*[F.col(f"`{c}`") if c in have else filler.alias(c) for c in ACCIDENT_FILE])


@query("src_csv_wide", f"WITH {cte('accidents')} SELECT * FROM accidents")
def src_csv_wide(spark, sf):
    """The declared columns of the public file's 46, picked by the names of the header."""
    path = scratch_path(spark, "wide")
    files.write_csv(wide(standin(spark, sf, "accidents")), path, packed=True)
    return files.read_csv(spark, path, ACCIDENTS)


#: Order lines as CSV text with columns in another order; some lines lack a field or have a text for a number.
_LINES = [
    ("o_orderkey % 10 = 0", "o_orderpriority || ',' || o_orderkey"),
    ("o_orderkey % 10 = 1", "o_orderpriority || ',x' || o_orderkey || ',' || o_custkey"),
    ("o_orderkey % 10 = 2", "o_orderpriority || ',' || o_orderkey || ',many,more'"),
    ("o_orderkey % 10 = 3", "o_orderpriority || ',' || o_orderkey || ',one'"),
]
_WHOLE = "o_orderpriority || ',' || o_orderkey || ',' || o_custkey"
_LINE = "CASE " + " ".join(f"WHEN {test} THEN {text}" for test, text in _LINES) + f" ELSE {_WHOLE} END"
_KEYS = T.StructType([T.StructField("o_custkey", T.LongType()), T.StructField("o_orderkey", T.LongType())])


def _order_lines(spark, sf):
    """Two files, each with its header: a line is a row of ``orders``."""
    path = scratch_path(spark, "order-lines")
    lines = load(spark, sf, "orders").select(F.expr(_LINE).alias("line"))
    # a header per part file, by the writer: the lines as one unquoted column of that name
    lines = lines.withColumnRenamed("line", "o_orderpriority,o_orderkey,o_custkey").coalesce(2)
    lines.write.options(header=True, sep="\u0001", quote="\u0002", escape="\u0003").csv(path)
    return files.read_csv_checked(spark, path, _KEYS)


@query("src_csv_checked", "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 10 > 3")
def src_csv_checked(spark, sf):
    """Whole lines of a CSV, by header name."""
    return _order_lines(spark, sf)[0]


@query(
    "src_csv_rejects",
    f"""SELECT {_LINE} AS line, CASE o_orderkey % 10 WHEN 1 THEN 'value of o_orderkey' WHEN 3 THEN 'value of o_custkey'
      ELSE 'number of fields' END AS reason FROM orders WHERE o_orderkey % 10 < 4""",
)
def src_csv_rejects(spark, sf):
    """Broken lines of a CSV, with the reason."""
    return _order_lines(spark, sf)[1]


@query("src_csv_dir", "SELECT * FROM orders")
def src_csv_dir(spark, sf):
    """A folder of part files read as one table."""
    path = scratch_path(spark, "orders")
    orders = load(spark, sf, "orders")
    files.write_csv(orders.repartition(4, "o_orderkey"), path, packed=True)
    return files.read_csv(spark, path, orders.schema)


@query(
    "src_address_lines",
    f"""WITH {cte('address_lines')}
    SELECT trim(split_part(line, '#', 1)) AS street, trim(split_part(line, '#', 2)) AS details,
      trim(split_part(line, '#', 1)) || ', ' || trim(split_part(line, '#', 2)) AS address
    FROM address_lines WHERE line LIKE '%#%'""",
)
def src_address_lines(spark, sf):
    path = scratch_path(spark, "addresses")
    standin(spark, sf, "address_lines").write.text(path)
    return files.read_address_lines(spark, path)[0]


@query(
    "src_address_rejects",
    f"""WITH {cte('address_lines')}
    SELECT line, 'no # in line' AS reason FROM address_lines WHERE line NOT LIKE '%#%'""",
)
def src_address_rejects(spark, sf):
    path = scratch_path(spark, "addresses")
    standin(spark, sf, "address_lines").write.text(path)
    return files.read_address_lines(spark, path)[1]


@query(
    "src_jsonl",
    """SELECT o_orderkey AS way_id, o_orderpriority AS highway, 'Road ' || o_custkey AS name,
      CAST(o_orderkey % 4 AS INTEGER) AS n_points, o_orderkey % 40 - 10 + 7e-1 AS temp,
      CAST(epoch(o_orderdate) AS BIGINT) AS dt FROM orders""",
)
def src_jsonl(spark, sf):
    """Nested road documents, one JSON document per line."""
    path = scratch_path(spark, "documents")
    standin(spark, sf, "documents_of_roads").write.json(path)
    return files.read_jsonl(spark, path, ROAD_EVENT).select(
        "way_id",
        "highway",
        "name",
        F.size("nodes_info").alias("n_points"),
        F.col("weather_info.main.temp").alias("temp"),
        F.col("weather_info.dt").alias("dt"),
    )


@query("src_scored", f"WITH {cte('scored')} SELECT * FROM scored")
def src_scored(spark, sf):
    """The scored table, written by event date."""
    path = scratch_path(spark, "scored")
    scored = standin(spark, sf, "scored").withColumn("event_date", F.to_date("ts"))
    scored.repartition("event_date").write.partitionBy("event_date").parquet(path)
    return files.read_scored(spark, path).drop("event_date")


_weather_columns = ["Temperature(C)", "Humidity(%)", "Weather_Condition", "Sunrise_Sunset"]


@query(
    "sink_csv_roundtrip",
    f"""WITH {cte('accidents')}, {CLEANED_SQL}
    SELECT {', '.join(f'"{c}"' for c in _weather_columns)}, count(*) AS "count" FROM cleaned
    GROUP BY ALL""",
)
def sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "counts")
    counts = count_conditions(clean_accidents(standin(spark, sf, "accidents")), _weather_columns)
    files.write_csv(counts, path, packed=True)
    return files.read_csv(spark, path, counts.schema)


@query(
    "sink_contract",
    f"""WITH {cte('scored')}
    SELECT event_id, name, danger_index, lat, lon FROM scored""",
)
def sink_contract(spark, sf):
    """Create a typed table, check the rows against it, append and read back."""
    location = scratch_path(spark, "contract")
    name = "contract_" + location.rsplit("-", 1)[1]
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("danger_index", T.DoubleType()),
            T.StructField(
                "location",
                T.StructType(
                    [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
                ),
            ),
        ]
    )
    files.ensure_table(spark, name, schema, location)
    rows = standin(spark, sf, "scored").select(
        "event_id", "name", "danger_index", F.struct("lat", "lon").alias("location")
    )
    files.append_table(rows, name)
    return spark.table(name).select("event_id", "name", "danger_index", "location.*")
