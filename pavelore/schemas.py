"""Declared schemas of every table, document and stream, so nothing is inferred at read time."""

from pyspark.sql import types as T

from .fixed import FLAGS


def _struct(**fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_text, _int, _long, _double = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Columns of the accident and road tables.
ACCIDENTS = _struct(
    **dict.fromkeys(["Street", "City", "County", "State"], _text),
    **dict.fromkeys(
        ["Temperature(F)", "Humidity(%)", "Pressure(in)", "Wind_Speed(mph)"], _double
    ),
    Weather_Condition=_text,
    **dict.fromkeys(FLAGS, T.BooleanType()),
    Sunrise_Sunset=_text,
)

ROADS = _struct(
    input_street=_text, input_city=_text, input_county=_text, input_state=_text, highway=_text
)

WAYS = _struct(way_id=_long, name=_text, highway=_text, nodes=T.ArrayType(_long))
NODES = _struct(node_id=_long, lat=_double, lon=_double)
POIS = _struct(poi_id=_long, lat=_double, lon=_double, tags=T.MapType(_text, _text))
GAZETTEER = _struct(address=_text, rank=_int, lat=_double, lon=_double)

# Flag order of a nested node.
NODE_FLAG_ORDER = [
    "Crossing", "Give_Way", "Railway", "Stop", "Traffic_Calming", "Traffic_Signal",
    "Amenity", "No_Exit", "Junction",
]
NODE_INFO = _struct(**dict.fromkeys(NODE_FLAG_ORDER, _int), lat=_double, lon=_double)

WEATHER_INFO = _struct(
    main=_struct(temp=_double, humidity=_double, pressure=_double),
    wind=_struct(speed=_double),
    weather=T.ArrayType(_struct(icon=_text)),
    dt=_long,
)

# Nested road event: one document per road, one nodes_info element per road point.
ROAD_EVENT = _struct(
    way_id=_long,
    highway=_text,
    name=_text,
    lista_coppie=T.ArrayType(T.ArrayType(_double)),
    nodes_info=T.ArrayType(NODE_INFO),
    weather_info=WEATHER_INFO,
)

# Flat point event on the stream. Whole-number fields arrive as JSON numbers that may
# carry a fraction, so they are declared double here and truncated by the decoder.
# Flag order of a point event.
POINT_FLAG_ORDER = [
    "Give_Way", "Crossing", "Traffic_Calming", "Traffic_Signal", "Railway", "Stop",
    "Amenity", "No_Exit", "Junction",
]
POINT_WHOLE_FIELDS = ["Temperature_C", "Humidity_%"] + POINT_FLAG_ORDER
POINT_EVENT = _struct(
    way_id=_long,
    highway=_text,
    name=_text,
    **{"Temperature_C": _int, "Humidity_%": _int},
    pressure_hPa=_double,
    wind_speed_meterSec=_double,
    weather_icon=_text,
    **dict.fromkeys(POINT_FLAG_ORDER, _int),
    lat=_double,
    lon=_double,
    weather_timestamp_iso8601=_text,
)

# Columns of a scored point, in order.
SCORED_COLUMNS = [
    "way_id", "highway", "name", "Temperature(C)", "Humidity(%)", "Pressure(in)",
    "Wind_Speed(mph)", "Sunrise_Sunset", "Weather_Condition", "Amenity", "Give_Way",
    "Crossing", "Traffic_Calming", "Traffic_Signal", "Railway", "Stop", "No_Exit",
    "Junction", "location", "weather_timestamp_iso8601", "danger_index",
]
_scored_types = {
    "way_id": _long, "highway": _text, "name": _text, "Sunrise_Sunset": _text,
    "Weather_Condition": _text, "location": _struct(lat=_double, lon=_double),
    "weather_timestamp_iso8601": T.TimestampType(), "danger_index": _double,
}
SCORED = _struct(**{c: _scored_types.get(c, _int) for c in SCORED_COLUMNS})
