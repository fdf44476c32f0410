"""Column functions on hand-made values."""

import math
import random
from datetime import datetime, timezone
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pavelore.fixed import ICON_CLASSES, SCENARIO_ICONS, WEATHER_CLASSES
from pavelore.functions import blocks, conditions, geo, strings, times, units
from pavelore.functions.nested import whole_number


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_rounding_halves_go_away_from_zero(spark):
    data = [(2.5,), (-2.5,), (0.49999999999999994,), (-9.5,), (None,)]
    got = values(spark, data, "x double", units.round_int(F.col("x")))
    assert got == [(3,), (-3,), (0,), (-10,), (None,)]


def test_serving_truncates_and_training_rounds(spark):
    """1010 hPa is 29.825 inHg."""
    columns = [units.hpa_to_inhg(F.col("p")), units.hpa_to_inhg(F.col("p"), "round")]
    assert values(spark, [(1010.0,)], "p double", *columns) == [(29, 30)]
    columns = [units.mps_to_mph(F.col("p")), units.mps_to_mph(F.col("p"), "round")]
    assert values(spark, [(8.0,)], "p double", *columns) == [(17, 18)]
    with pytest.raises(ValueError):
        units.to_int(F.lit(1.0), "floor")


def test_fahrenheit(spark):
    got = values(spark, [(32.0,), (212.0,), (None,)], "f double", units.f_to_c(F.col("f")))
    assert got[0] == (0.0,) and got[1][0] == pytest.approx(100.0) and got[2] == (None,)


def test_boxcox_at_zero_is_the_logarithm(spark):
    near, at = units.boxcox(F.col("x"), 1e-9), units.boxcox(F.col("x"), 0.0)
    [(a, b)] = values(spark, [(7.0,)], "x double", near, at)
    assert a == pytest.approx(math.log(7), rel=1e-6) and b == pytest.approx(math.log(7))


def test_bool_to_int_keeps_null(spark):
    data = [(True,), (False,), (None,)]
    assert values(spark, data, "b boolean", conditions.bool_to_int(F.col("b"))) == [(1,), (0,), (None,)]


def test_day_night_null_is_night(spark):
    data = [("01d",), ("01n",), ("",), (None,), ("01x",)]
    got = values(spark, data, "i string", conditions.day_night(F.col("i")))
    assert [g[0] for g in got] == ["Day", "Night", "Night", "Night", "Night"]


def test_icon_class_covers_18_icons(spark):
    assert len(SCENARIO_ICONS) == 18
    data = [(i,) for i in [*SCENARIO_ICONS, "01x", "1d", None]]
    got = [g[0] for g in values(spark, data, "i string", conditions.icon_class(F.col("i")))]
    assert got == [ICON_CLASSES[i[:2]] for i in SCENARIO_ICONS] + ["unknown"] * 3


def test_weather_texts_are_complete():
    texts = [t for group in WEATHER_CLASSES.values() for t in group]
    assert len(set(texts)) == 144 and len(WEATHER_CLASSES) == 9
    assert set(WEATHER_CLASSES) == set(ICON_CLASSES.values())


def test_split_address(spark):
    data = [(" W Iowa Ave # Sunnyvale California ",), ("no mark",), ("a#b#c",), ("\t x#y ",)]
    line = F.col("line")
    got = values(spark, data, "line string", strings.street_of(line), strings.details_of(line),
                 strings.full_address(line))
    assert got == [
        ("W Iowa Ave", "Sunnyvale California", "W Iowa Ave, Sunnyvale California"),
        (None, None, None),
        ("a", "b#c", "a, b#c"),
        ("x", "y", "x, y"),
    ]


def test_token_sort(spark):
    data = [("West Iowa, Avenue",), ("  ÉCOLE d'Or ",), ("...",), ("a_b C",), (None,)]
    got = [g[0] for g in values(spark, data, "t string", strings.token_sort(F.col("t")))]
    assert got == ["avenue iowa west", "cole d or", "", "a_b c", None]


def test_similarity_is_the_block_ratio_not_edit_distance(spark):
    pairs = [("ave iowa w", "avenue iowa west"), ("", "x"), ("x", "x"), (None, "x")]
    got = values(spark, pairs, "a string, b string", strings.similarity(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [77, 0, 100, None]


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_length_bound_is_an_upper_bound(a, b):
    if a and b:
        bound = 200 * min(len(a), len(b)) / (len(a) + len(b))
        assert bound + 1e-9 >= 100 * SequenceMatcher(None, a, b).ratio()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abc é", max_size=14), st.text("abc é", max_size=14)), max_size=8))
def test_batched_ratios_equal_the_block_ratio(pairs):
    got = blocks.ratios([a for a, _ in pairs], [b for _, b in pairs])
    want = [round(100 * SequenceMatcher(None, a, b).ratio()) if a and b else 0 for a, b in pairs]
    assert got.tolist() == want


def test_batched_ratios_of_many_and_of_long_texts():
    rng = random.Random(1)
    words = ["avenue", "iowa", "west", "street", "st", "oak", "a", "of", "saint", "sant"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 6, 40, 60]))) for _ in range(600)]
    a, b = texts[:300], texts[300:]
    want = [round(100 * SequenceMatcher(None, x, y).ratio()) for x, y in zip(a, b)]
    assert blocks.ratios(a, b).tolist() == want
    for least in (1, 50, 70, 71, 95):
        i, j = blocks.possible(blocks.Texts(a), blocks.Texts(b), least)
        open_ = set(zip(i.tolist(), j.tolist()))
        assert all((k, k) in open_ for k, score in enumerate(want) if score >= least)
        assert len(open_) < 90_000 or least == 1


def test_segment_distance(spark):
    data = [(0.001, 0.5, 0.0, 0.0, 0.0, 1.0), (0.0, 1.5, 0.0, 0.0, 0.0, 1.0), (0.0, -179.5, 0.0, 179.0, 0.0, -179.0),
            (10.0, 10.0, 10.0, 10.0, 10.0, 10.0), (10.0, 10.01, 10.0, 10.0, 10.0, 10.0), (89.99, 90.0, 89.99, 0.0, 89.99, 180.0),
            (37.00001, 15.0, 37.0, 15.0 - 1e-9, 37.0, 15.0 + 1e-9)]
    columns = ["lat", "lon", "lat1", "lon1", "lat2", "lon2"]
    got = values(spark, data, ", ".join(f"{c} double" for c in columns), geo.segment_distance_m(*(F.col(c) for c in columns)))
    degree = geo.EARTH_RADIUS_M * math.pi / 180
    want = [0.001 * degree, 0.5 * degree, 0.0, 0.0, 0.01 * math.cos(math.radians(10)) * degree, 0.01 * degree, 1e-5 * degree]
    assert [g[0] for g in got] == pytest.approx(want, abs=2e-3)


def test_epoch_and_iso(spark):
    data = [("1721922246",), ("1721922246.5",), ("x",), (None,)]
    ts = times.epoch_to_timestamp(F.col("s"))
    got = [g[0] for g in values(spark, data, "s string", times.to_iso8601(ts))]
    assert got == ["2024-07-25T15:44:06.000Z", "2024-07-25T15:44:06.500Z", None, None]


def test_parse_iso_or_epoch(spark):
    data = [("2024-07-25T15:44:06.000Z",), ("1721922246000",), ("2024-07-25",), ("later",), (None,)]
    got = values(spark, data, "s string", F.unix_millis(times.parse_iso_or_epoch(F.col("s"))))
    assert [g[0] for g in got] == [1721922246000, 1721922246000, 1721865600000, None, None]


def test_version_stamp():
    moment = datetime(2024, 7, 25, 15, 44, 5, tzinfo=timezone.utc)
    assert times.version_stamp(moment) == "2024-07-25_15-44-05_GMT"


def test_whole_number_truncates_and_never_throws(spark):
    data = [("12.7",), ("-1.9",), ("%{[a]}",), ("NaN",), ("1e20",), (None,)]
    got = [g[0] for g in values(spark, data, "s string", whole_number(F.col("s")))]
    assert got == [12, -1, None, None, None, None]


def test_haversine(spark):
    data = [(0.0, 0.0, 0.0, 1.0), (0.0, 179.5, 0.0, -179.5), (90.0, 0.0, -90.0, 0.0)]
    cols = [F.col(c) for c in "abcd"]
    got = [g[0] for g in values(spark, data, "a double, b double, c double, d double",
                                geo.haversine_m(*cols))]
    degree = math.pi * 6371000 / 180
    assert got == pytest.approx([degree, degree, 180 * degree])


@pytest.mark.parametrize("lat", [0.0, 37.2, -60.0, 89.9995])
def test_cells_touched_hold_every_place_of_the_circle(spark, lat):
    """Places all over the circle fall into a cell the circle touches; each cell is listed once."""
    radius, rows = 600.0, []
    for i in range(72):
        for share in (0.0, 0.5, 0.999999):
            d, angle = share * radius / 6371000.0, math.radians(5 * i)
            p1 = math.radians(lat)
            p2 = math.asin(math.sin(p1) * math.cos(d) + math.cos(p1) * math.sin(d) * math.cos(angle))
            dl = math.atan2(math.sin(angle) * math.sin(d) * math.cos(p1),
                            math.cos(d) - math.sin(p1) * math.sin(p2))
            lon = (179.9999 + math.degrees(dl) + 180) % 360 - 180
            rows.append((math.degrees(p2), lon))
    df = spark.createDataFrame(rows, "lat double, lon double")
    touched = geo.cells_touched(F.lit(lat), F.lit(179.9999), F.lit(radius), radius)
    cell = geo.cell_at(F.col("lat"), F.col("lon"), radius)
    got = df.select(F.array_contains(touched, cell).alias("in"),
                    (F.size(F.array_distinct(touched)) == F.size(touched)).alias("once")).distinct().collect()
    assert [tuple(r) for r in got] == [(True, True)]


def test_child_cells_nest(spark):
    rows = [(37 + i * 0.00137, 15 - i * 0.00211) for i in range(500)] + [(-0.001, -180.0), (0.0, 180.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    lat, lon = F.col("lat"), F.col("lon")
    for level in range(3):
        parent, child = geo.cell_at(lat, lon, 100.0, level), geo.cell_at(lat, lon, 100.0, level + 1)
        centre = geo.cell_centre(child, 100.0, level + 1)
        bad = df.filter(
            ~F.array_contains(geo.cell_children(parent), child)
            | (geo.haversine_m(lat, lon, *centre) > geo.cell_reach_m(child, 100.0, level + 1))
        )
        assert bad.count() == 0


def test_letters_bound_is_never_below_the_score(spark):
    import random

    rng = random.Random(4)
    words = ["via roma", "corso_2", "main st", "st main", "a", "", "zz top", "3 elm", "elm 33"]
    text = lambda: " ".join(sorted(rng.choice(words) for _ in range(rng.randint(0, 3)))).strip()
    pairs = spark.createDataFrame([(text(), text()) for _ in range(400)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = pairs.select(strings.letters_bound(a, b).alias("bound"), strings.similarity(a, b).alias("score")).collect()
    assert all(r.bound + 0.5 >= r.score for r in got)
