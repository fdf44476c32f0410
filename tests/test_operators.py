"""Operators on hand-made rows; one test per trap and per skew rule."""

import math
import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from pavelore.fixed import CONDITIONS, EARTH_RADIUS_M, FLAGS, MAP_BOUNDS
from pavelore.functions import geo
from pavelore.operators import (
    cleaning, geocoding, labels, matching, nearby, nearest, ranking, relational, report, roads, scenario, skew,
)
from pavelore.schemas import NODES, POIS, ROAD_EVENT, WAYS
from pavelore.session import materialize, scratch_path
from rows import GOOD, MAIN, accidents, north, road_tables
from rows import roads as road_rows


def listed(df):
    return sorted(tuple(r) for r in df.collect())


# ------------------------------------------------------------------ cleaning


def test_every_required_column_drops_its_null(spark):
    changes = [{c: None} for c in cleaning.REQUIRED]
    df = accidents(spark, {}, {"Street": None}, *changes)
    assert cleaning.clean_accidents(df).count() == 2  # the key may be null at this stage


def test_cleaning_converts(spark):
    df = accidents(
        spark,
        {"Temperature(F)": 14.9, "Weather_Condition": "Rain and Sleet", "Stop": True},
        {"Temperature(F)": 36.5, "Weather_Condition": "Meteor Shower"},
    )
    got = listed(cleaning.clean_accidents(df).select(
        "Temperature(C)", "Pressure(in)", "Wind_Speed(mph)", "Weather_Condition", "Stop", "Junction"))
    assert got == [(-10, 30, 4, "shower rain", 1, 0), (3, 30, 4, "Unknown", 0, 0)]


def test_classify_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("Rain and Sleet", 1), (None, 2), ("clear", 3)], "w string, i int")
    got = listed(cleaning.classify(df, "w", cleaning.weather_dimension(spark)).select("i", "w"))
    assert got == [(1, "shower rain"), (2, "Unknown"), (3, "Unknown")]


# ------------------------------------------------------------------ joins


def test_join_roads_null_keys_and_duplicates(spark):
    df = accidents(spark, {}, {"City": None}, {"Street": "Elm St"})
    both = road_rows(spark, MAIN, MAIN, (None, "Springfield", "Sangamon", "IL", "x"),
                     ("Oak", "A", "B", "C", "y"))
    assert roads.join_roads(df, both).count() == 2
    with pytest.raises(Exception, match="duplicate key"):
        roads.join_roads(df, both, unique=True).collect()
    assert roads.join_roads(df, road_rows(spark, MAIN), unique=True).count() == 1


def skewed(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 400).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return left, right.unionByName(right.filter("k = 7"))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    left, right = skewed(spark)
    plain = left.join(right, "k", how)
    salted = skew.balanced_join(left, right, ["k"], how, salt=True)
    assert salted.columns == plain.columns
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, salted.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_size_settings():
    sizes = ["10485760b", "10485760", "10MB", "10m", "1g", "-1", "-1b", "2 KiB"]
    assert [skew.as_bytes(s) for s in sizes] == [10 << 20] * 4 + [1 << 30, -1, -1, 2048]


def test_hot_keys_are_few_and_found(spark):
    left, _ = skewed(spark)
    assert listed(skew.hot_keys(left, ["k"], 0.3)) == [(7,)]


def test_salting_spreads_the_hot_key(spark):
    left, right = skewed(spark)
    joined = skew.salted_join(left, right, ["k"], spread_by=["v"], pieces=8)
    spread = F.pmod(F.xxhash64("v"), F.lit(8))
    assert joined.filter("k = 7").select(spread).distinct().count() == 8


def test_without_adaptive_execution_joins_are_salted(spark):
    left, right = skewed(spark)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = skew.balanced_join(left, right, ["k"])
        assert "_piece" in joined._jdf.queryExecution().toString()
        assert joined.count() == left.join(right, "k").count()
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert "SortMergeJoin" in left.join(right, "k")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_way_nodes_keep_way_order_and_count_a_closing_node_once(spark):
    ways = spark.createDataFrame([(1, "a", "x", [3, 1, 2, 3]), (2, "b", "x", [9])], WAYS)
    nodes = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 2.0), (3, 3.0, 3.0)], NODES)
    located = roads.way_nodes(ways, nodes)
    assert listed(located.select("way_id", "pos", "node_id")) == [(1, 0, 3), (1, 1, 1), (1, 2, 2)]
    assert listed(roads.first_node(located).select("way_id", "node_id")) == [(1, 3)]


def test_copies_of_ways_do_not_multiply(spark):
    ways = spark.createDataFrame([(1, "Main", "x", [3, 1])] * 50, WAYS)
    nodes = spark.createDataFrame([(1, 1.0, 1.0), (3, 3.0, 3.0)], NODES)
    located = roads.way_nodes(ways, nodes)
    assert located.count() == 2
    flagged = located.unionByName(located).withColumns({f: F.lit(0) for f in FLAGS})
    [document] = nearby.road_documents(ways, flagged).collect()
    assert [n["lat"] for n in document["nodes_info"]] == [3.0, 1.0]
    places = spark.createDataFrame([("main", 1.0, 1.0)] * 30, "street string, lat double, lon double")
    assert matching.scored_candidates(places, ways, located).count() == 1


def test_geocode_takes_the_first_result(spark):
    tables = road_tables(spark)
    addresses = spark.createDataFrame(
        [("W Iowa Ave, Sunnyvale",), ("W Iowa Ave, Sunnyvale",), ("Nowhere",)], "address string")
    assert listed(roads.geocode(addresses, tables.gazetteer)) == [("W Iowa Ave, Sunnyvale", 37.0, 15.0)] * 2
    skipped = relational.rejects(addresses, tables.gazetteer, ["address"], "address not found")
    assert listed(skipped) == [("Nowhere", "address not found")]


def test_weather_needs_a_listed_condition(spark):
    schema = ROAD_EVENT["weather_info"].dataType
    make = lambda dt, icons: ((1.0, 2.0, 3.0), (4.0,), icons, dt)
    obs = spark.createDataFrame(
        [(1, make(10, [("01d",)])), (1, make(20, [("02d",)])), (1, make(30, [])), (1, make(40, None)),
         (2, make(50, None))],
        "place int, weather_info " + schema.simpleString())
    road = spark.createDataFrame([(100, 1), (101, 1), (102, 2), (103, 3)], "way_id int, place int")
    got = roads.attach_weather(road, obs, ["place"]).select("way_id", "weather_info.dt")
    assert listed(got) == [(100, 20), (101, 20)]


def test_append_keeps_duplicates_and_matches_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, i int")
    assert listed(relational.append(a, b, a)) == [(1, "x")] * 3


# ------------------------------------------------------------------ counts and labels


def test_counting_before_the_join_gives_the_same_counts(spark):
    df = accidents(spark, {}, {}, {"Stop": True}, {"Street": None}, {"Street": "Elm St"})
    both = road_rows(spark, MAIN, MAIN, MAIN[:4] + ("primary",))
    clean = cleaning.clean_accidents(df)
    expected = listed(labels.count_conditions(roads.join_roads(clean, both)))
    assert listed(labels.count_joined_conditions(clean, both)) == expected
    assert sorted(r[-1] for r in expected) == [1, 2, 2, 4]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert listed(labels.count_joined_conditions(clean, both)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def condition_table(spark, counts):
    rows = [(i, c) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, "cond int, count long")


def test_large_and_small_top_n_agree(spark, monkeypatch):
    rng = random.Random(1)
    df = condition_table(spark, [rng.choice([1, 1, 1, 2, 3, 9]) for _ in range(1000)]).repartition(7)
    order = [F.col("count").desc(), F.col("cond").asc()]
    for n in (1, 17, 400, 999, 1000, 5000):
        small = listed(labels.most_frequent(df, n, ["cond"]))
        monkeypatch.setattr(ranking, "HEAP_LIMIT", 0)
        monkeypatch.setattr(labels, "HEAP_LIMIT", 0)
        assert listed(labels.most_frequent(df, n, ["cond"])) == small
        assert listed(ranking.top_n(df, n, order)) == small
        monkeypatch.undo()
        assert len(small) == min(n, 1000)


def test_global_rank_numbers_without_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 101).alias("a"), "id").repartition(9)
    got = ranking.global_rank(df, [F.desc("a"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 1001))
    keys = [(-r["a"], r["id"]) for r in got]
    assert keys == sorted(keys)


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = ranking.top_per_group(df, ["g"], [F.desc("v")], 2)
    assert listed(top) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()


def test_frequency_index_ties_are_alphabetical(spark):
    df = spark.createDataFrame([(x,) for x in "bbaacz"] + [(None,)], "s string")
    got = [tuple(r) for r in ranking.frequency_index(df, "s").orderBy("s_indexed").collect()]
    assert got == [("a", 2, 0.0), ("b", 2, 1.0), ("c", 1, 2.0), ("z", 1, 3.0)]


def dense_lambda(x, low, high):
    lx = np.log(x)
    grid = np.linspace(low, high, 40001)
    t = lx - lx.mean()
    best = [np.var(np.expm1(g * t) / g if abs(g) > 1e-12 else t) for g in grid]
    at = int(np.argmin(best))
    assert 0 < at < len(grid) - 1  # the grid holds the optimum
    return grid[at]


@pytest.mark.parametrize("make, low, high", [
    (lambda rng: np.exp(rng.normal(size=400)), -1, 1),
    (lambda rng: rng.integers(1, 200, 400).astype(float) + 1, 0, 2),
    (lambda rng: np.where(rng.random(400) < 0.9, 2.0, rng.integers(3, 9, 400)), -20, -1),
    (lambda rng: rng.beta(8, 1, 400) + 0.01, 2, 10),
])
def test_exponent_equals_a_dense_grid(spark, make, low, high):
    x = make(np.random.default_rng(3))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert labels.boxcox_lambda(df, "x") == pytest.approx(dense_lambda(x, low, high), abs=(high - low) / 30000)


def test_label_is_monotone_and_between_0_and_1(spark):
    table, _ = labels.risk_label(condition_table(spark, [1, 1, 1, 2, 3, 50]))
    rows = sorted((r["count"], r["count_bc"], r["row_count_norm"]) for r in table.collect())
    assert rows[0][2] == 0.0 and rows[-1][2] == 1.0
    assert [r[2] for r in rows] == sorted(r[2] for r in rows) and rows[0][0] == 1


def test_equal_counts(spark):
    df = condition_table(spark, [4, 4])
    assert labels.add_minmax(df, "count").select("row_count_norm").distinct().collect()[0][0] is None
    with pytest.raises(ValueError, match="equal"):
        labels.risk_label(df)


# ------------------------------------------------------------------ radius


def brute(points, marks, radius):
    def distance(a, b):
        p, q = math.radians(a[0]), math.radians(b[0])
        h = (math.sin((q - p) / 2) ** 2
             + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)
        return 2 * 6371000.0 * math.asin(math.sqrt(min(1, h)))

    return sorted({(p[0], p[1], m[2]) for p in points for m in marks if distance(p, m) <= radius})


@pytest.mark.parametrize("centre", [(37.0, 15.0), (0.0, 0.0), (-72.0, 179.9995), (89.9985, 40.0)])
@pytest.mark.parametrize("limit", [10**9, 40])
def test_radius_join_equals_brute_force(spark, centre, limit):
    """Spread-out places and a hot cell; a low limit forces the cut into smaller cells."""
    rng = random.Random(5)

    def place(scale):
        lat = min(90.0, centre[0] + rng.uniform(-scale, scale))
        lon = centre[1] + rng.uniform(-scale, scale) / max(0.02, math.cos(math.radians(lat)))
        return (lat, (lon + 180) % 360 - 180)

    points = [place(0.002) for _ in range(80)] + [place(0.0002) for _ in range(40)]
    points += points[:20]
    marks = [(*place(0.002), rng.choice("abc")) for _ in range(60)]
    marks += [(*place(0.0002), rng.choice("abcd")) for _ in range(40)]
    got = nearby.tags_near(
        spark.createDataFrame(points, "lat double, lon double"),
        spark.createDataFrame(marks, "lat double, lon double, tag string"),
        100.0, pair_limit=limit)
    assert listed(got) == brute(points, marks, 100.0)


def test_crowded_cell_is_cut(spark, monkeypatch):
    """Marks and points in one cell: covered small cells take tags without pair tests."""
    tested = []
    original = nearby._tested

    def spy(here, todo, on, distance):
        tested.append(here.join(todo, on).count())
        return original(here, todo, on, distance)

    monkeypatch.setattr(nearby, "_tested", spy)
    rng = random.Random(6)
    near = lambda: (37.0005 + rng.uniform(0, 1e-4), 15.0005 + rng.uniform(0, 1e-4))
    points, marks = [near() for _ in range(300)], [(*near(), "a") for _ in range(300)]
    got = nearby.tags_near(
        spark.createDataFrame(points, "lat double, lon double"),
        spark.createDataFrame(marks, "lat double, lon double, tag string"), 100.0, pair_limit=1000)
    assert listed(got) == brute(points, marks, 100.0) and len(tested) > 1
    assert sum(tested) < 300 * 300 / 10


def flags_of(spark, pois, strict=False):
    point = spark.createDataFrame([(1, 37.0, 15.0)], "id int, lat double, lon double")
    row = nearby.poi_flags(point, spark.createDataFrame(pois, POIS), strict).first()
    return sorted(f for f in FLAGS if row[f] == 1)


def test_flag_radii(spark):
    """29 and 31 m around the short radius, 99 and 101 m around the long one."""
    pois = [
        (1, north(29), 15.0, {"highway": "crossing"}), (2, north(31), 15.0, {"highway": "stop"}),
        (3, north(99), 15.0, {"noexit": "no"}), (4, north(101), 15.0, {"amenity": "cafe"}),
        (5, north(1), 15.0, {"highway": "street_lamp"}), (6, north(2), 15.0, {"railway": "x"}),
    ]
    assert flags_of(spark, pois) == ["Crossing", "No_Exit", "Railway"]


def test_feature_with_two_tags(spark):
    """An amenity 80 m away that is also a crossing sets both flags, unless strict."""
    pois = [(1, north(80), 15.0, {"amenity": "cafe", "highway": "crossing"})]
    assert flags_of(spark, pois) == ["Amenity", "Crossing"]
    assert flags_of(spark, pois, strict=True) == ["Amenity"]


def test_points_without_features_keep_zeros_and_copies(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0)], "id int, lat double, lon double")
    flagged = nearby.poi_flags(points, spark.createDataFrame([], POIS))
    assert [sum(r[f] for f in FLAGS) for r in flagged.collect()] == [0, 0]


def test_long_way_continues_in_parts(spark):
    nodes = spark.range(7).selectExpr("1L as way_id", "cast(id as int) as pos", "100 - id as node_id")
    lists = nearby.collect_nodes(nodes.repartition(3), ["node_id"], limit=3)
    got = {r["part"]: [n["node_id"] for n in r["nodes_info"]] for r in lists.collect()}
    assert got == {0: [100, 99, 98], 1: [97, 96, 95], 2: [94]}


# ------------------------------------------------------------------ names


def test_best_name_keeps_all_its_ways_and_no_tied_other_name(spark):
    rows = [(1, "iowa avenue west", 99), (2, "West Iowa Avenue", 100), (3, "West Iowa Avenue", 100),
            (4, "iowa avenue west ", 100)]
    scored = spark.createDataFrame(
        [("W", 0.0, 0.0, n, s, i) for i, n, s in rows],
        "street string, lat double, lon double, name string, score int, way_id long")
    assert listed(matching.best_names(scored).select("way_id", "name")) == [
        (2, "West Iowa Avenue"), (3, "West Iowa Avenue")]


def test_candidates_equal_brute_force(spark):
    tables = road_tables(spark)
    located = roads.way_nodes(tables.ways, tables.nodes)
    places = [("W Iowa Ave", 37.0, 15.0), ("W Iowa Ave", 37.0, 15.0), ("Iowa Avenue W", north(-350), 15.0),
              ("East Iowa", north(-350), 15.0), ("Iowa Avenue East", north(300), 15.0)]
    df = spark.createDataFrame(places, "street string, lat double, lon double")
    words = lambda text: " ".join(sorted(text.lower().split()))
    names = {r["way_id"]: r["name"] for r in tables.ways.collect() if r["name"]}
    marks = [(r["lat"], r["lon"], r["way_id"]) for r in located.collect() if r["way_id"] in names]
    for min_score in (0, 70):
        want = set()
        for street, lat, lon in places:
            for _, _, way in brute([(lat, lon)], marks, 600.0):
                score = round(100 * SequenceMatcher(None, words(street), words(names[way])).ratio())
                if score >= min_score:
                    want.add((street, lat, lon, names[way], score, way))
        got = matching.scored_candidates(df, tables.ways, located, min_score)
        assert listed(got.select("street", "lat", "lon", "name", "score", "way_id")) == sorted(want)


def test_names_below_70_are_left_out(spark):
    pairs = spark.createDataFrame(
        [("W Iowa Ave", "West Iowa Avenue"), ("W Iowa Ave", "Harbour Road"), ("W Iowa Ave", None)],
        "street string, name string")
    assert listed(matching.score_names(pairs)) == [("W Iowa Ave", "West Iowa Avenue", 77)]


def test_more_than_100_ways_of_the_best_name(spark):
    rows = [("Main", 0.0, 0.0, "Main", 100, i) for i in range(150)]
    scored = spark.createDataFrame(
        rows, "street string, lat double, lon double, name string, score int, way_id long")
    assert matching.best_names(scored).count() == 150
    assert matching.top_candidates(scored, ["street", "lat", "lon"]).count() == 100


def test_radius_join_with_equal_columns_and_own_radii(spark):
    rng = random.Random(9)
    place = lambda: (37 + rng.uniform(0, 0.002), 15 + rng.uniform(0, 0.002), rng.choice("xy"))
    points = [place() for _ in range(60)]
    marks = [(*place(), rng.choice("ab"), rng.choice([30.0, 100.0])) for _ in range(60)]
    for limit in (10**9, 20):
        got = nearby.tags_near(
            spark.createDataFrame(points, "lat double, lon double, kind string"),
            spark.createDataFrame(marks, "lat double, lon double, kind string, tag string, radius double"),
            100.0, same=["kind"], pair_limit=limit)
        want = set()
        for kind in "xy":
            for radius in (30.0, 100.0):
                here = [p for p in points if p[2] == kind]
                around = [(m[0], m[1], m[3]) for m in marks if m[2] == kind and m[4] == radius]
                want |= {(a, b, kind, t) for a, b, t in brute(here, around, radius)}
        assert listed(got) == sorted(want)


# ------------------------------------------------------------------ report and scenarios


def scored(spark):
    rows = [(f"road {i}", float(i + j) / 10, 37.5 + i / 100, 15.0, 60 * i) for i in range(8) for j in (0, 1)]
    rows += [(None, 9.0, 37.5, 15.0, 0), ("empty", None, 0.0, 0.0, 9999)]
    df = spark.createDataFrame(rows, "name string, danger_index double, lat double, lon double, s long")
    return df.withColumn("ts", F.timestamp_seconds("s"))


def test_top_roads_and_other(spark):
    rows = report.top_roads(scored(spark)).collect()
    assert len(rows) == 6
    other = [r for r in rows if r["is_other"]][0]
    assert other["name"] == "Other" and other["avg_danger"] == pytest.approx(0.15)
    assert {r["name"] for r in rows if not r["is_other"]} == {f"road {i}" for i in range(3, 8)}
    few = report.top_roads(scored(spark).filter("name in ('road 1', 'road 2')")).collect()
    assert sorted(r["name"] for r in few) == ["road 1", "road 2"]


def test_road_metrics_of_a_road_without_values_are_null(spark):
    row = report.road_metrics(scored(spark)).filter("name = 'empty'").first()
    assert (row["avg_danger"], row["min_danger"], row["max_danger"]) == (None, None, None)


def test_recent_and_bounds(spark, capsys):
    df = scored(spark).filter("name <> 'empty'")
    assert report.recent(df, "ts", minutes=2).select("name").distinct().count() == 3
    path = scratch_path(spark, "scored")
    df.write.parquet(path)
    now = F.lit(120).cast("timestamp")
    for given, pushed in ((None, ["Greater"]), (now, ["Greater", "Less"])):
        report.recent(spark.read.parquet(path), "ts", given).explain("formatted")
        plan = capsys.readouterr().out
        assert all(f"{side}ThanOrEqual(ts" in plan for side in pushed)
    assert report.recent(df, "ts", now, 1).select("name").distinct().count() == 2
    inside = report.in_bounds(df)
    assert inside.agg(F.max("lat")).first()[0] <= MAP_BOUNDS["max_lat"]
    assert inside.count() == 16


def test_scenarios(spark):
    event = (1, "x", "n", None, [], ((1.0, 2.0, 3.0), (4.0,), [("01d",), ("02d",)], 5))
    df = spark.createDataFrame([event], ROAD_EVENT)
    assert scenario.scenario_rows(df.select("way_id")).distinct().count() == 648
    events = scenario.scenario_events(df, F.lit(77))
    assert events.columns == df.columns and events.distinct().count() == 648
    first = events.select("weather_info.dt", F.col("weather_info.weather")[1]["icon"]).distinct()
    assert listed(first) == [(77, "02d")]
    assert "Join" not in events._jdf.queryExecution().toString()


def test_scenarios_are_dealt_to_all_tasks(spark):
    one = spark.range(40).coalesce(1).withColumnRenamed("id", "way_id")
    rows = scenario.scenario_rows(one)
    assert rows.select(F.spark_partition_id()).distinct().count() > 1 and rows.count() == 40 * 648


def test_packed_files_are_not_taken_for_small_tables(spark):
    path = scratch_path(spark, "same-text")
    text = F.lit("a way of one name that many files repeat " * 3)
    spark.range(400_000).select((F.col("id") % 7).alias("k"), text.alias("text")).write.parquet(path)
    packed, few = spark.read.parquet(path), spark.range(7).withColumnRenamed("id", "k")
    assert skew.looks_small(packed) and not skew.fits_broadcast(packed) and skew.fits_broadcast(few)
    joined = skew.balanced_join(few, packed, ["k"])
    assert joined.count() == 400_000 and "Broadcast" not in joined._jdf.queryExecution().toString()


def test_accidents_of_large_road_tables_are_shuffled_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    hot = [{"Humidity(%)": float(h % 9)} for h in range(60)]
    clean = cleaning.clean_accidents(accidents(spark, *hot, {"Street": "Side St"}, {"Street": None}).repartition(5))
    both = road_rows(spark, MAIN, MAIN, (MAIN[0], *MAIN[1:4], "primary"), ("Side St", *MAIN[1:4], "primary"))
    expected = listed(labels.count_conditions(roads.join_roads(clean, both)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = labels.count_joined_conditions(clean, both)
        plan = counts._jdf.queryExecution().sparkPlan().toString()
        assert listed(counts) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # accidents by key, roads by group and by key, the result by condition
    executed = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert executed.count("Exchange hashpartitioning") == 4, plan


def test_whitelist_matches_exact_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "lat int, latitude int, lon int")
    assert relational.whitelist(df, ["lon", "lat", "x"]).columns == ["lon", "lat"]


def test_first_per_group_aggregates_without_a_window(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    first = relational.first_per_group(df, ["k"], [F.col("o")])
    assert listed(first.select("k", "o")) == [("a", 1), ("b", 5)]
    assert "Window" not in first._jdf.queryExecution().toString()


def test_nearest_weather_crosses_cell_borders(spark):
    info = "weather_info struct<main: struct<temp: double>, weather: array<struct<icon: string>>, dt: bigint>"
    make = lambda temp, dt, icons=("01d",): ((temp,), [(i,) for i in icons], dt)
    road = spark.createDataFrame(
        [(1, 37.0999, 15.0), (2, 37.0999, 15.0), (3, 60.0, 15.0), (4, None, 15.0), (5, 0.0, 179.99999)],
        "way_id int, first_lat double, first_lon double")
    seen = spark.createDataFrame(
        [(37.1001, 15.0, make(1.0, 10)), (37.1001, 15.0, make(2.0, 20)), (37.05, 15.0, make(3.0, 99)),
         (37.0999, 15.0, make(4.0, 99, ())), (60.5, 15.0, make(5.0, 1)), (0.0, -179.99999, make(6.0, 1))],
        "lat double, lon double, " + info)
    got = roads.nearest_weather(road, seen, 10_000.0).select("way_id", "weather_info.main.temp")
    assert listed(got) == [(1, 2.0), (2, 2.0), (5, 6.0)]


def test_top_n_keeps_its_order_beyond_the_heap(spark, monkeypatch):
    from pavelore.operators import ranking

    rows = spark.range(200).select(((F.col("id") * 37) % 200).alias("v"))
    for limit in (10_000, 10):
        monkeypatch.setattr(ranking, "HEAP_LIMIT", limit)
        assert [r.v for r in ranking.top_n(rows, 50, [F.col("v")]).collect()] == list(range(50))


def test_training_partitions_follow_from_the_rows(spark, monkeypatch):
    from pavelore.operators import model

    monkeypatch.setattr(model, "ROWS_PER_TASK", 100)
    rows = spark.range(700).select("id", (F.col("id") % 7).alias("k"))
    dealt = [
        model._spread(df).withColumn("p", F.spark_partition_id()).collect()
        for df in (rows.coalesce(1), rows.repartition(5), rows.repartition(3, "k"))
    ]
    assert dealt[0] == dealt[1] == dealt[2] and len({r.p for r in dealt[0]}) == 7


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from pavelore.session import shared_folder

    def session(master):
        conf = SimpleNamespace(get=lambda *a: None)
        context = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_folder(session("local[4]"))
    with pytest.raises(ValueError):
        shared_folder(session("spark://host:7077"))


def test_a_long_way_continues_in_further_documents(spark):
    flags = {f: 0 for f in FLAGS}
    names = ["way_id", "pos", "node_id", "lat", "lon", *flags]
    nodes = spark.createDataFrame([(1, i, i, 37.0, 15.0, *flags.values()) for i in range(25)], names)
    ways = spark.createDataFrame([(1, "x", "n")], "way_id long, highway string, name string")
    parts = nearby.road_documents(ways, nodes, limit=10).select("part", F.size("nodes_info")).collect()
    assert sorted(map(tuple, parts)) == [(0, 10), (1, 10), (2, 5)]
    assert nearby.road_documents(ways, nodes, limit=25).count() == 1


def test_an_exploded_side_is_counted_before_it_is_broadcast(spark):
    from pavelore.operators.skew import balanced_join

    keys = spark.range(300).select("id")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for copies, broadcast in ((2, True), (20_000, False)):
        many = keys.select("id", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
        joined = balanced_join(spark.range(300).select("id"), many, ["id"])
        assert ("BroadcastHashJoin" in plan(joined)) == broadcast
        assert joined.count() == 300 * copies


def test_nearest_marks_equal_brute_force(spark):
    """Places and marks around the antimeridian, a pole and a cell border; ties go by order."""
    rng = random.Random(4)
    spots = [(0.0, 179.99), (89.95, 20.0), (10.0, 10.0), (-45.0, -179.995)]
    near = lambda lat, lon, w: (max(-90.0, min(90.0, lat + rng.uniform(-w, w))), (lon + rng.uniform(-w, w) + 180) % 360 - 180)
    places = [near(*spots[i % 4], 0.1) for i in range(300)]
    marks = {near(*spots[i % 4], 0.12): i for i in range(400)}
    marks |= {near(10.0, 10.0, 1e-5): 1000 + i for i in range(200)}
    marks[(11.0, 10.0)] = marks[(11.0, 10.02)] = 5
    places += [(11.0, 10.01), (50.0, 50.0)]
    got = nearest.nearest_marks(
        spark.createDataFrame([*places, (None, 1.0)], "lat double, lon double"),
        spark.createDataFrame([(*k, v) for k, v in marks.items()], "lat double, lon double, v int"),
        5000.0, F.col("v"), "v")

    def metres(a, b):
        p, q, x, y = map(math.radians, (a[0], b[0], a[1], b[1]))
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((y - x) / 2) ** 2
        return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(1, h)))

    want = {}
    for p in places:
        far, v = min((metres(p, m), v) for m, v in marks.items())
        if far <= 5000:
            want[p] = v
    assert {(r.lat, r.lon): r.v for r in got.collect()} == want
    assert len(want) > 250 and (50.0, 50.0) not in want


def test_nearest_marks_in_a_dense_cell_make_few_pairs(spark, monkeypatch):
    """100,000 places and 30,000 marks in one cell of 10 km, a third of the marks in one spot."""
    made = []
    met = nearest._met

    def counted(pairs, *rest):
        found = met(pairs, *rest)
        made.append(pairs.count())
        return found

    monkeypatch.setattr(nearest, "_met", counted)
    draw = lambda n, seed, size: spark.range(n).select(
        (10 + F.rand(seed) * size).alias("lat"), (10 + F.rand(seed + 1) * size).alias("lon"), F.col("id").alias("v"))
    marks = materialize(draw(20_000, 1, 0.08).unionByName(draw(10_000, 3, 1e-4)))
    places = materialize(draw(100_000, 5, 0.08).drop("v"))
    found = nearest.nearest_marks(places, marks, 10_000.0, F.col("v"), "v")
    assert found.count() == 100_000
    assert sum(made) < 4_000_000  # all pairs are three thousand million
    some = found.join(places.orderBy("lat", "lon").limit(20), ["lat", "lon"]).collect()
    points = [(r.lat, r.lon, r.v) for r in marks.collect()]
    for r in some:
        flat = lambda m: (m[0] - r.lat) ** 2 + ((m[1] - r.lon) * math.cos(math.radians(r.lat))) ** 2
        best = min(points, key=flat)
        chosen = next(m for m in points if m[2] == r.v and flat(m) <= flat(best) * 1.001)
        assert flat(chosen) <= flat(best) * 1.001


def test_ways_by_line_distance(spark):
    """A long straight way whose nodes are far off, across 180 degrees, short ones and a lone node."""
    nodes = spark.createDataFrame(
        [(1, 37.0, 15.0), (2, 37.0, 15.5), (3, -10.0, 179.9), (4, -10.0, -179.9), (5, 50.0, 0.0), (6, 50.0, 0.0)],
        "node_id long, lat double, lon double")
    ways = spark.createDataFrame(
        [(1, [1, 2]), (2, [3, 4, 3]), (3, [5, 6]), (4, [5, 99, 5]), (1, [1, 2]), (5, None)], "way_id long, nodes array<long>")
    segments = roads.way_segments(ways, nodes)
    assert segments.count() == 7  # (1,2) 2 alone; (3,4) (4,3) 3 alone; ways 3 and 4 one place each
    points = [(37.0004, 15.25, {1}), (37.009, 15.25, set()), (-10.001, 180.0, {2}), (-10.0, -179.99, {2}),
              (50.003, 0.0, {3, 4}), (37.0, 14.9999, {1}), (37.0, 14.9, set()), (0.0, 0.0, set())]
    got = nearby.way_lines_near(spark.createDataFrame([p[:2] for p in points], "lat double, lon double"), segments)
    found = {}
    for r in got.collect():
        found.setdefault((r.lat, r.lon), set()).add(r.way_id)
    assert found == {p[:2]: p[2] for p in points if p[2]}


@pytest.mark.parametrize("limit", [4_000_000, 50])
def test_segments_near_equal_brute_force(spark, limit):
    rng = random.Random(7)
    spots = [(0.0, 179.99), (89.97, 20.0), (10.0, 10.0)]
    near = lambda i, w: (min(90.0, spots[i % 3][0] + rng.uniform(-w, w)), (spots[i % 3][1] + rng.uniform(-w, w) + 180) % 360 - 180)
    points = [near(i, 0.05) for i in range(250)]
    lines = []
    for i in range(120):
        a = near(i, 0.05)
        b = a if i % 10 == 0 else near(i, 0.05 if i % 4 else 0.001)
        lines.append((*a, *b, i))
    got = nearby.segments_near(
        spark.createDataFrame(points, "lat double, lon double"),
        spark.createDataFrame(lines, "lat1 double, lon1 double, lat2 double, lon2 double, tag int"), 700.0, pair_limit=limit)

    def vector(lat, lon):
        p, q = math.radians(lat), math.radians(lon)
        return np.array([math.cos(p) * math.cos(q), math.cos(p) * math.sin(q), math.sin(p)])

    def metres(p, line):
        """Least distance from many places along the arc."""
        a, b = vector(*line[:2]), vector(*line[2:4])
        t = np.linspace(0, 1, 4001)[:, None]
        arc = a + t * (b - a)
        arc /= np.linalg.norm(arc, axis=1, keepdims=True)
        return float((2 * EARTH_RADIUS_M * np.arcsin(np.minimum(1, np.linalg.norm(arc - vector(*p), axis=1) / 2))).min())

    found = {(r.lat, r.lon, r.tag) for r in got.collect()}
    for p in points:
        for line in lines:
            far = metres(p, line)
            if abs(far - 700) > 1:
                assert ((*p, line[4]) in found) == (far < 700), (p, line, far)
    assert len(found) > 300


@pytest.mark.parametrize("limit", [200_000, 9])
def test_way_lines_are_found_where_places_and_lines_meet(spark, monkeypatch, limit):
    """Rows keep their columns and copies, crowded blocks are dealt to groups, and no pair is shuffled."""
    monkeypatch.setattr(nearby, "PLACES_TOGETHER", 7)
    rng = random.Random(5)
    near = lambda: (37.0 + rng.uniform(0, 0.05), 15.0 + rng.uniform(0, 0.05))
    spots = [near() for _ in range(60)]
    points = [(i, *spots[i % 60 if i < 80 else 0]) for i in range(110)] + [(3, *spots[3]), (None, *spots[4]), (200, None, 15.0)]
    ways = [(w, *near(), *near()) for w in range(25) for _ in range(3)]
    df = spark.createDataFrame(points, "address_id long, lat double, lon double")
    segments = spark.createDataFrame(ways + ways[:5], "way_id long, lat1 double, lon1 double, lat2 double, lon2 double")
    beside = geo.segment_distance_m(*map(F.col, ("lat", "lon", "lat1", "lon1", "lat2", "lon2"))) <= 600
    found = df.select("lat", "lon").distinct().crossJoin(segments).filter(beside).select("lat", "lon", "way_id").distinct()
    want = df.join(found, ["lat", "lon"]).select("address_id", "lat", "lon", "way_id")
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    got = nearby.way_lines_near(df, segments)
    assert got.columns == want.columns
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    want = order(want.collect())
    assert order(got.collect()) == want and len(want) > 500
    tags = nearby.segments_near(df, segments.withColumnRenamed("way_id", "tag"), 600.0, pair_limit=limit)
    assert order(tags.collect()) == sorted({r[1:] for r in want}, key=repr)


def many_names(spark):
    """Streets and ways of alike names, all near each other."""
    rng = random.Random(3)
    near = lambda: (37.0 + rng.uniform(0, 0.008), 15.0 + rng.uniform(0, 0.008))
    text = lambda i: f"{'North' if i % 2 else 'South'} Main Road {i % 13}"
    places = [(text(i), *near()) for i in range(40)] * 2
    ways = [(i, text(i) if i % 7 else None, "x") for i in range(60)] + [(5, "Main Road", "x")]
    lines = [(i, *near(), *near()) for i in range(60) for _ in range(2)]
    return (
        spark.createDataFrame(places, "street string, lat double, lon double"),
        spark.createDataFrame(ways, "way_id long, name string, highway string"),
        spark.createDataFrame(lines, "way_id long, lat1 double, lon1 double, lat2 double, lon2 double"),
    )


@pytest.mark.parametrize("keep", ["best", 3])
def test_ways_are_chosen_where_names_are_scored(spark, monkeypatch, keep):
    places, ways, lines = many_names(spark)
    names = ["street", "lat", "lon", "name", "score", "way_id"]
    scored = materialize(matching.scored_candidates(places, ways, lines, 0))
    beside = geo.segment_distance_m(*map(F.col, ("lat", "lon", "lat1", "lon1", "lat2", "lon2"))) <= 600
    near = places.distinct().crossJoin(lines).filter(beside).select("street", "lat", "lon", "way_id").distinct()
    near = near.join(nearby.named_ways(ways), "way_id").select("street", "lat", "lon", "name", "way_id")
    assert listed(scored.select(*near.columns)) == listed(near)
    assert {(r.street, r.name): r.score for r in matching.score_names(near, 0).collect()} == {
        (r.street, r.name): r.score for r in scored.collect()}
    if keep == "best":
        want = matching.best_names(scored)
    else:
        want = matching.top_candidates(scored, ["street", "lat", "lon"], keep)
    monkeypatch.setattr(nearby, "PLACES_TOGETHER", 6)
    got = matching.scored_candidates(places, ways, lines, 0, keep=keep)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    assert listed(got.select(*names)) == listed(want.select(*names))


def test_matching_addresses_writes_no_pairs(spark, monkeypatch):
    """What is checkpointed grows with the addresses, not with the ways of alike names around them."""
    from pavelore.plans import enrich

    written = []

    def counted(df):
        df = materialize(df)
        written.append(df.count())
        return df

    for module in (enrich, matching):
        monkeypatch.setattr(module, "materialize", counted)
    ways = [(i, f"Main Road {i}", "x", [i]) for i in range(40)]
    nodes = [(i, north(i), 15.0) for i in range(40)]
    addresses = [(f"Main Road {i}", f"Main Road {i}, {i % 2}") for i in range(30)]
    tables = enrich.RoadTables(
        spark.createDataFrame([(a, 1, north(100), 15.0) for _, a in addresses], "address string, rank int, lat double, lon double"),
        spark.createDataFrame(ways, WAYS), spark.createDataFrame(nodes, NODES), spark.createDataFrame([], POIS))
    matched, skipped = enrich.match_addresses(spark.createDataFrame(addresses * 2, "street string, address string"), tables)
    assert listed(matched.select("address", "way_id")) == sorted((a, int(s.split()[-1])) for s, a in addresses)
    assert skipped.count() == 0
    assert sum(written) <= 4 * len(addresses)


@pytest.mark.parametrize("together", [2000, 3])
def test_names_by_cell_equal_all_pairs(spark, together):
    rng = random.Random(2)
    words = ["via", "roma", "street", "st", "oak", "elm", "grand", "avenue", "ave", "north", "piazza", "x", "été"]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    long = " ".join(words) * 6
    streets = [((i % 3, 0), text()) for i in range(60)] + [((0, 0), ""), ((0, 0), None), ((1, 0), long), ((9, 9), "via roma")]
    names = [((i % 3, 0), text()) for i in range(60)] + [((0, 0), "é"), ((1, 0), long + " z")]
    cell = "struct<row:long,column:long>"
    a, b = (spark.createDataFrame(rows, f"cell {cell}, {c} string") for rows, c in ((streets, "street"), (names, "name")))
    got = {(r.street, r.name): r.score for r in matching.score_names_by_cell(a, b, 70, together).collect()}
    pairs = a.join(b, "cell").select("street", "name")
    want = {(r.street, r.name): r.score for r in matching.score_names(pairs).collect()}
    assert got == want and len(want) > 40


def test_geocode_text_rules(spark):
    gazetteer = spark.createDataFrame(
        [("Main Street 5, Springfield", 2, 1.0, 1.0), ("Main Street 5, Springfield", 1, 2.0, 2.0), ("Main Street 7, Shelbyville", 1, 3.0, 3.0),
         ("North Oak Avenue 5, Springfield", 1, 4.0, 4.0), ("Élan Straße 9", 1, 5.0, 5.0), (None, 1, 6.0, 6.0), ("", 1, 7.0, 7.0),
         ("Twin Road 1, A", 3, 8.0, 8.0), ("Twin Road 1, B", 2, 9.0, 9.0), ("Twin Road 1, C", 2, 10.0, 10.0)],
        "address string, rank int, lat double, lon double")
    asked = [("springfield, MAIN st. 5", 2.0), ("5 Oak ave N, Springfield", 4.0), ("élan straße 9!", 5.0), ("Twin Rd 1", 9.0),
             ("Shelbyville main street", 3.0), ("somewhere else entirely", None), (None, None), ("", None), ("...", None),
             ("Main Street 5, Springfield, third floor left at the back door of it", None)]
    rows = spark.createDataFrame([(a, "x") for a, _ in asked], "address string, more string")
    got = {r.address: r.lat for r in geocoding.geocode_text(rows, gazetteer).collect()}
    assert got == {a: lat for a, lat in asked if lat is not None}
    assert geocoding.geocode_text(rows, gazetteer.limit(0)).count() == 0
    loose = geocoding.geocode_text(rows, gazetteer, min_coverage=20).filter("address LIKE '%third floor%'").first()
    assert loose["found"].startswith("Main Street 5") and 0.2 <= loose["coverage"] < 0.6


def test_z_ranges_hold_the_rectangle(spark):
    rng = random.Random(5)
    for _ in range(40):
        south, north = sorted(rng.uniform(-90, 90) for _ in range(2))
        west, east = rng.uniform(-180, 180), rng.uniform(-180, 180)
        ranges = geo.z_ranges(south, west, north, east)
        assert 0 < len(ranges) <= 32 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        inside = lambda lon: west <= lon <= east if west <= east else lon >= west or lon <= east
        points = [(rng.uniform(south, north), lon) for lon in (rng.uniform(-180, 180) for _ in range(200)) if inside(lon)]
        points += [(south, west), (north, east), (south, east)]
        cells = spark.createDataFrame(points, "lat double, lon double").select(geo.z_cell(F.col("lat"), F.col("lon")).alias("c"))
        assert all(any(low <= r.c <= high for low, high in ranges) for r in cells.collect())
        if (north - south) * ((east - west) % 360) < 2000 and north - south > 1:
            assert sum(high - low + 1 for low, high in ranges) < 2**32 / 4
    assert geo.z_ranges(1.0, 0.0, -1.0, 1.0) == []


def test_a_map_rectangle_reads_few_rows(spark, tmp_path):
    """Files in Z-order: a rectangle of a hundredth of the area reads a small part of the rows."""
    points = spark.range(40_000).select((30 + F.rand(1) * 10).alias("lat"), (10 + F.rand(2) * 10).alias("lon"), "id")
    points = points.withColumn("cell", geo.z_cell(F.col("lat"), F.col("lon")))
    points.repartitionByRange(50, "cell").sortWithinPartitions("cell").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    found = report.in_bounds(table, min_lat=33.0, max_lat=34.0, min_lon=14.0, max_lon=15.0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = found._jdf.queryExecution().executedPlan()
        rows = plan.executeCollect()
        metrics = plan.collectLeaves().head().metrics()
        read = metrics.get("numOutputRows").get().value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = table.drop("cell").filter("lat BETWEEN 33 AND 34 AND lon BETWEEN 14 AND 15").count()
    assert len(rows) == want > 300
    assert read < 6000


def test_tasks_that_count_accidents_follow_from_their_number(spark, monkeypatch):
    monkeypatch.setattr(labels, "DEALT_ROWS", 4, raising=False)
    hot = [{"Humidity(%)": float(h % 9)} for h in range(90)]
    clean = cleaning.clean_accidents(accidents(spark, *hot, {"Street": "Side St"}, {"Street": None}))
    both = road_rows(spark, MAIN, MAIN, ("Side St", *MAIN[1:4], "primary"))
    expected = listed(labels.count_conditions(roads.join_roads(clean, both)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = labels.count_joined_conditions(clean, both)
        assert listed(counts) == expected
        assert f", {-(-91 // 4)}), REPARTITION_BY_NUM" in counts._jdf.queryExecution().executedPlan().toString()
        nothing = labels.count_joined_conditions(clean.limit(0), both)
        assert listed(nothing) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pairs_of_many_places_are_held_by_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "TASK_PLACES", 10, raising=False)
    parts, whole, bounded = [], [], nearest._bounded

    def seen(pairs, *rest):
        held = bounded(pairs, *rest)
        parts.append(held.rdd.getNumPartitions())
        return held

    met_with = nearest._met
    monkeypatch.setattr(nearest, "_bounded", seen)
    monkeypatch.setattr(nearest, "_met", lambda pairs, marks, *rest: whole.append(marks.columns) or met_with(pairs, marks, *rest))
    places = spark.range(95).select((F.col("id") / 1e3).alias("lat"), F.lit(1.0).alias("lon"))
    text = F.struct(F.col("id").alias("dt"), F.array(F.lit("a long text")).alias("texts")).alias("v")
    marks = spark.range(40).select((F.col("id") * 2 / 1e3).alias("lat"), F.lit(1.0).alias("lon"), text)
    found = nearest.nearest_marks(places, marks, 500.0, -F.col("v.dt"), "v")
    got = {round(r.lat * 1e3): r.v.dt for r in found.collect()}
    assert sorted(got) == list(range(83)) and all(abs(min(i, 78) - 2 * v) <= 1 for i, v in got.items())
    assert parts[0] == 10 and found.schema["v"].dataType == marks.schema["v"].dataType
    assert all("v" not in columns for columns in whole)
