"""Hand-written input rows."""

from pavelore.fixed import FLAGS
from pavelore.schemas import ACCIDENTS, GAZETTEER, NODES, POIS, ROADS, WAYS

COLUMNS = [f.name for f in ACCIDENTS.fields]
GOOD = {
    "Street": "Main St", "City": "Springfield", "County": "Sangamon", "State": "IL",
    "Temperature(F)": 50.0, "Humidity(%)": 40.0, "Pressure(in)": 29.5, "Wind_Speed(mph)": 3.5,
    "Weather_Condition": "Clear", **dict.fromkeys(FLAGS, False), "Sunrise_Sunset": "Day",
}


def accidents(spark, *changes):
    rows = [tuple({**GOOD, **change}[c] for c in COLUMNS) for change in changes]
    return spark.createDataFrame(rows, ACCIDENTS)


def roads(spark, *rows):
    return spark.createDataFrame(list(rows), ROADS)


MAIN = ("Main St", "Springfield", "Sangamon", "IL", "residential")


def north(metres, lat=37.0):
    """Latitude a number of metres north."""
    import math

    return lat + math.degrees(metres / 6371000.0)


def road_tables(spark):
    """Two ways of one name, a similar and a dissimilar name, a shared node, features around."""
    from pavelore.plans.enrich import RoadTables

    ways = [
        (1, "West Iowa Avenue", "residential", [10, 11]),
        (2, "West Iowa Avenue", "residential", [11, 12]),
        (3, "East Iowa Avenue", "tertiary", [13]),
        (4, "Harbour Road", "primary", [10]),
        (5, None, "primary", [10]),
    ]
    nodes = [
        (10, 37.0, 15.0), (11, north(200), 15.0), (12, north(400), 15.0), (13, north(500), 15.0),
    ]
    pois = [
        (1, north(29), 15.0, {"highway": "crossing"}),
        (2, north(231), 15.0, {"highway": "stop"}),
        (3, north(301), 15.0, {"noexit": "no"}),
        (4, north(480), 15.0, {"amenity": "cafe", "highway": "crossing"}),
    ]
    gazetteer = [
        ("W Iowa Ave, Sunnyvale", 2, 0.0, 0.0),
        ("W Iowa Ave, Sunnyvale", 1, 37.0, 15.0),
        ("Nothing Like It, Sunnyvale", 1, 37.0, 15.0),
    ]
    make = spark.createDataFrame
    return RoadTables(
        make(gazetteer, GAZETTEER), make(ways, WAYS), make(nodes, NODES), make(pois, POIS)
    )
