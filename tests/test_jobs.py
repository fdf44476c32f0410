"""The four jobs end to end on hand-written rows."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pavelore.catalog.files import wide
from pavelore.fixed import FEATURES, FLAGS, LABEL
from pavelore.operators import model
from pavelore.plans import emit, enrich, report, score, train
from pavelore.schemas import ROAD_EVENT, ROADS
from pavelore.session import scratch_path
from pavelore.sources import streams
from pavelore.sources.files import read_scored, write_csv
from pavelore.streaming import scoring
from pavelore.streaming.points import flatten_documents
from rows import MAIN, accidents, road_tables, roads

KINDS = ["residential", "primary", "tertiary"]


@pytest.fixture(scope="module")
def table(spark):
    changes = [
        {"Street": f"S{i % 6}", "Temperature(F)": 30.0 + 9 * (i % 5), "Wind_Speed(mph)": float(i % 3),
         "Weather_Condition": ["Clear", "Rain", "Snow", "Fog"][i % 4], "Stop": i % 2 == 0,
         "Sunrise_Sunset": "Night" if i % 7 == 0 else "Day"}
        for i in range(600)
    ]
    both = roads(spark, *[(f"S{i}", *MAIN[1:4], KINDS[i % 3]) for i in range(6)])
    labelled, lam = train.training_table(accidents(spark, *changes), both)
    assert isinstance(lam, float)
    return labelled


@pytest.fixture(scope="module")
def fitted(table):
    return model.train(table, trees=5, depth=4, on_invalid="error")


def test_label_range(table):
    low, high = table.agg(F.min(LABEL), F.max(LABEL)).first()
    assert (low, high) == (0.0, 1.0) and {"count", "count_bc"} <= set(table.columns)


def test_top_n_cut_of_the_training_table(spark):
    df = accidents(spark, *[{"Temperature(F)": 30.0 + 9 * i} for i in range(5) for _ in range(i + 1)])
    labelled, _ = train.training_table(df, roads(spark, MAIN), n=3)
    assert sorted(r["count"] for r in labelled.collect()) == [3, 4, 5]


def test_save_load_and_report(spark, table):
    folder = scratch_path(spark, "models")
    fit, version = train.train_and_save(table, folder, trees=3, depth=3)
    assert version.endswith("_GMT")
    loaded = model.load_model(folder, version)
    a = [r[0] for r in fit.transform(table).select("prediction").collect()]
    b = [r[0] for r in loaded.transform(table).select("prediction").collect()]
    assert sorted(a) == sorted(b)
    rows = spark.read.parquet(f"{folder}/{version}/report").orderBy("position").collect()
    assert [r["metric"] for r in rows] == ["min_pred", "max_pred", "rmse"] + [f"importance {f}" for f in FEATURES]
    values = {r["metric"]: r["value"] for r in rows}
    assert 0 <= values["min_pred"] <= values["max_pred"] <= 1 and values["rmse"] >= 0
    assert sum(r["value"] for r in rows[3:]) == pytest.approx(1)


def test_rmse_equals_the_evaluator(fitted, table):
    from pyspark.ml.evaluation import RegressionEvaluator

    predictions = fitted.transform(table)
    expected = RegressionEvaluator(labelCol=LABEL, metricName="rmse").evaluate(predictions)
    assert model.evaluate(predictions).first()["rmse"] == pytest.approx(expected)


def test_more_than_32_categories(spark, table):
    many = table.limit(60).withColumn("highway", F.concat(F.lit("h"), F.monotonically_increasing_id() % 40))
    assert model.bins_needed(many) > 32
    assert model.train(many, trees=1, depth=2).transform(many).count() == 60


def test_same_seed_same_forest(table, fitted):
    again = model.train(table, trees=5, depth=4)
    assert list(again.stages[-1].featureImportances.toArray()) == pytest.approx(
        list(fitted.stages[-1].featureImportances.toArray()))


POINT = {"way_id": 1, "highway": "primary", "name": "n", "Temperature_C": 12, "Humidity_%": 40,
         "pressure_hPa": 1010.0, "wind_speed_meterSec": 1.0, "weather_icon": "01d",
         **{f: 0 for f in FLAGS}, "lat": 37.5, "lon": 15.0,
         "weather_timestamp_iso8601": "2024-07-25T15:44:06.000Z"}


def send(spark, folder, *values):
    texts = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
    spark.createDataFrame(texts, "value string").write.mode("append").text(folder)


def test_score_job_with_side_outputs(spark, fitted):
    folder, path = scratch_path(spark, "topic"), scratch_path(spark, "scored")
    send(spark, folder, POINT, {**POINT, "highway": "moonway"}, {**POINT, "weather_icon": None},
         {**POINT, "Humidity_%": None}, '{"way_id": 1, "hi',
         {**POINT, "way_id": 2, "weather_timestamp_iso8601": "1721922246000"})

    def run():
        for stream in score.start(streams.read_messages(spark, "text", folder), fitted,
                                  f"{path}/out", f"{path}/checkpoint", "reject"):
            stream.awaitTermination()
        return [spark.read.parquet(f"{path}/out/{n}").count() for n in ("scored", "broken", "rejected")]

    assert run() == [2, 1, 3]
    assert run() == [2, 1, 3]
    send(spark, folder, POINT)
    assert run() == [3, 1, 3]
    scored = read_scored(spark, f"{path}/out/scored")
    assert {str(r[0]) for r in scored.select("event_date").collect()} == {"2024-07-25"}
    now = F.lit("2024-07-25 15:50:00").cast("timestamp")
    assert report.recent_points(scored, now).count() == 3
    assert "PartitionFilters: [isnotnull(event_date" in report.recent_points(
        scored, now)._jdf.queryExecution().toString()
    assert report.map_points(scored, now).count() == 3
    assert [r["name"] for r in report.risk_table(scored, now).collect()] == ["n"]
    out = scratch_path(spark, "report")
    report.write_report(scored, now, out)
    assert spark.read.parquet(f"{out}/points").count() == 3
    assert [r["name"] for r in spark.read.parquet(f"{out}/roads").collect()] == ["n"]
    assert report.recent_points(scored, F.lit("2024-07-25 17:00:00").cast("timestamp")).count() == 0


def test_unseen_category_stops_the_query_by_default(spark, fitted):
    good = spark.createDataFrame([(json.dumps(POINT).encode(),)], "value binary")
    assert score.scored_messages(good, fitted).count() == 1
    bad = spark.createDataFrame([(json.dumps({**POINT, "highway": "moonway"}).encode(),)], "value binary")
    with pytest.raises(Exception, match="Unseen label|moonway"):
        score.scored_messages(bad, fitted).collect()
    with pytest.raises(ValueError):
        score.scored_messages(good, fitted, "ignore")


def test_batch_and_stream_scores_are_equal(spark, fitted):
    folder, path = scratch_path(spark, "topic"), scratch_path(spark, "both")
    send(spark, folder, *[{**POINT, "Temperature_C": t, "way_id": t} for t in range(20)])
    stream = score.scored_messages(streams.read_messages(spark, "text", folder), fitted)
    streams.append_stream(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    batch = score.scored_messages(spark.read.text(folder), fitted)
    key = lambda df: sorted((r["way_id"], r["danger_index"]) for r in df.collect())
    assert key(spark.read.parquet(f"{path}/out")) == key(batch)


def test_enrich_job(spark, fitted):
    tables = road_tables(spark)
    addresses = spark.createDataFrame(
        [("W Iowa Ave", "W Iowa Ave, Sunnyvale")] * 2
        + [("Nothing Like It", "Nothing Like It, Sunnyvale"), ("Lost", "Lost, Nowhere")],
        "street string, address string")
    matched, skipped = enrich.match_addresses(addresses, tables)
    assert sorted(r["way_id"] for r in matched.collect()) == [1, 2]
    assert sorted((r["street"], r["reason"]) for r in skipped.collect()) == [
        ("Lost", "address not found"), ("Nothing Like It", "no similar way")]
    documents = enrich.describe_roads(matched, tables)
    rows = {r["way_id"]: r for r in documents.collect()}
    assert set(rows) == {1, 2}
    assert [n["lat"] for n in rows[1]["nodes_info"]] == [p[0] for p in rows[1]["lista_coppie"]]
    assert rows[1]["lista_coppie"][0] == [37.0, 15.0]
    flags = [{f for f in FLAGS if n[f]} for n in rows[1]["nodes_info"]]
    # the second node sees the feature 100 m off, not the one 101 m off or the stop 31 m off
    assert flags == [{"Crossing"}, set()]
    assert [{f for f in FLAGS if n[f]} for n in rows[2]["nodes_info"]] == [
        set(), {"No_Exit", "Amenity", "Crossing"}]

    info = ROAD_EVENT["weather_info"].dataType.simpleString()
    seen = spark.createDataFrame(
        [(37.01, 15.02, ((5.0, 40.0, 1010.0), (1.0,), [("01d",)], 100)),
         (37.02, 15.01, ((6.0, 40.0, 1010.0), (1.0,), [("10n",)], 200)),
         (50.0, 15.0, ((9.0, 40.0, 1010.0), (1.0,), [("10n",)], 300))],
        f"lat double, lon double, weather_info {info}")
    complete, missing = enrich.add_weather(documents, seen)
    assert missing.count() == 0
    # the nearer observation, though the other one is newer
    assert {r[0] for r in complete.select("weather_info.main.temp").collect()} == {5.0}
    copies = enrich.all_copies(addresses, matched, complete)
    assert copies.count() == 4
    many = addresses.crossJoin(spark.range(1250).drop("id"))
    assert enrich.all_copies(many, matched, complete).groupBy("way_id").count().collect()[0][1] == 2500
    points = flatten_documents(complete)
    assert points.count() == 4 and points.select("weather_timestamp_iso8601").distinct().count() == 1
    none, all_missing = enrich.add_weather(documents, seen.filter("lat > 40"))
    assert none.count() == 0 and all_missing.count() == 2


def test_demonstration_run(spark, fitted):
    """Documents under all settings, flattened, sent and scored: 648 rows per point."""
    node = tuple([0] * 9) + (37.5, 15.0)
    event = (1, "primary", "n", [[37.5, 15.0]], [node, node],
             ((1.0, 2.0, 3.0), (4.0,), [("01d",)], 1721922246))
    sent = emit.scenario_messages(spark.createDataFrame([event], ROAD_EVENT), F.lit(1721922246))
    points = scoring.decode_readable(sent)
    scored = score.scored_messages(sent, fitted, on_invalid="reject")
    labels = fitted.stages[0].labelsArray[1]
    known = 648 * 2 * len(labels) // 9
    assert points.count() == 648 * 2 and scored.count() == known
    low, high = scored.agg(F.min("danger_index"), F.max("danger_index")).first()
    assert 0 <= low <= high <= 1


def test_live_messages_are_sent_once_per_update(spark):
    """Two roads in one place, one elsewhere; a restart sends nothing again."""
    node = tuple([0] * 9) + (37.5, 15.0)
    info = ROAD_EVENT["nodes_info"].dataType.simpleString()
    roads_table = spark.createDataFrame(
        [(i, 0, "x", f"n{i}", [[37.5, 15.0]], [node] * 3, 37.5 if i < 3 else 1.0, 15.0) for i in (1, 2, 3)],
        "way_id long, part int, highway string, name string, lista_coppie array<array<double>>,"
        f" nodes_info {info}, first_lat double, first_lon double")
    arrived, path = scratch_path(spark, "updates"), scratch_path(spark, "live")

    def update(temperature):
        weather = {"main": {"temp": temperature}, "weather": [{"icon": "01d"}], "dt": 1721922246}
        send(spark, arrived, {"lat": 37.55, "lon": 15.05, "weather_info": weather})

    def run():
        updates = streams.read_documents(spark, arrived, emit.UPDATE)
        emit.start_live(updates, roads_table, f"{path}/out", f"{path}/checkpoint",
                        every_seconds=None).awaitTermination()
        return scoring.decode_readable(spark.read.text(f"{path}/out"))

    update(12.7)
    assert run().count() == 6 and run().count() == 6
    update(20)
    got = run().groupBy("way_id", "Temperature_C").count().collect()
    assert sorted(map(tuple, got)) == [(1, 12, 3), (1, 20, 3), (2, 12, 3), (2, 20, 3)]


def road_documents(spark, places):
    node = tuple([0] * 9) + (37.5, 15.0)
    info = ROAD_EVENT["nodes_info"].dataType.simpleString()
    return spark.createDataFrame(
        [(i, 0, "x", f"n{i}", [[37.5, 15.0]], [node], *place) for i, place in places.items()],
        "way_id long, part int, highway string, name string, lista_coppie array<array<double>>,"
        f" nodes_info {info}, first_lat double, first_lon double")


class Live:
    """A live job over updates that arrive in files."""

    def __init__(self, spark, places):
        self.spark, self.documents = spark, road_documents(spark, places)
        self.arrived, self.path = scratch_path(spark, "updates"), scratch_path(spark, "live")

    def update(self, *seen):
        send(self.spark, self.arrived, *[
            {"lat": lat, "lon": lon, "weather_info": {"main": {"temp": temp}, "weather": [{"icon": "01d"}], "dt": dt}}
            for lat, lon, temp, dt in seen])

    def run(self):
        updates = streams.read_documents(self.spark, self.arrived, emit.UPDATE)
        emit.start_live(updates, self.documents, f"{self.path}/out", f"{self.path}/checkpoint",
                        every_seconds=None).awaitTermination()
        sent = scoring.decode_readable(self.spark.read.text(f"{self.path}/out"))
        return sorted((r["way_id"], r["Temperature_C"]) for r in sent.collect())


def test_a_road_hears_from_its_nearest_station_only(spark):
    live = Live(spark, {1: (37.5, 15.0), 2: (37.56, 15.0), 3: (1.0, 1.0)})
    live.update((37.51, 15.0, 10, 100), (37.55, 15.0, 20, 100))
    assert live.run() == [(1, 10), (2, 20)]
    live.update((37.55, 15.0, 21, 200))  # station of road 2, in reach of road 1
    assert live.run() == [(1, 10), (2, 20), (2, 21)]
    live.update((37.51, 15.0, 9, 50))  # an older observation that arrives late
    assert live.run() == [(1, 10), (2, 20), (2, 21)]
    live.update((37.501, 15.0, 11, 10))  # a nearer station
    assert live.run() == [(1, 10), (1, 11), (2, 20), (2, 21)]
    assert live.run() == [(1, 10), (1, 11), (2, 20), (2, 21)]
    live.update((37.51, 15.0, 12, 300), (37.56, 15.0, 22, 1))
    assert live.run() == [(1, 10), (1, 11), (2, 20), (2, 21), (2, 22)]


def test_a_live_batch_that_failed_is_sent_once(spark, monkeypatch):
    live = Live(spark, {1: (37.5, 15.0), 2: (37.56, 15.0)})
    live.update((37.51, 15.0, 10, 100))
    assert live.run() == [(1, 10), (2, 10)]
    write = emit.write_batch

    def failing(rows, out, batch, format):
        write(rows, out, batch, format)
        raise RuntimeError("lost after writing")

    monkeypatch.setattr(emit, "write_batch", failing)
    live.update((37.51, 15.0, 11, 200))
    with pytest.raises(Exception, match="lost after writing"):
        live.run()
    monkeypatch.setattr(emit, "write_batch", write)
    assert live.run() == [(1, 10), (1, 11), (2, 10), (2, 11)]


def test_score_job_repeats_nothing_after_a_crash_between_outputs(spark, fitted, monkeypatch):
    folder, path = scratch_path(spark, "topic"), scratch_path(spark, "scored")
    write = score.write_batch

    def run():
        for stream in score.start(streams.read_messages(spark, "text", folder), fitted,
                                  f"{path}/out", f"{path}/checkpoint", "reject"):
            stream.awaitTermination()

    def counts():
        return [spark.read.parquet(f"{path}/out/{n}").count() for n in ("scored", "broken", "rejected")]

    send(spark, folder, POINT, "{", {**POINT, "highway": "moonway"})
    run()
    assert counts() == [1, 1, 1]

    def failing(rows, target, batch, **settings):
        if target.endswith("broken"):
            raise RuntimeError("lost between outputs")
        write(rows, target, batch, **settings)

    monkeypatch.setattr(score, "write_batch", failing)
    send(spark, folder, {**POINT, "way_id": 2}, "[", {**POINT, "highway": None})
    with pytest.raises(Exception, match="lost between outputs"):
        run()
    assert spark.read.parquet(f"{path}/out/scored").count() == 2
    monkeypatch.setattr(score, "write_batch", write)
    run()
    assert counts() == [2, 2, 2]
    assert spark.read.parquet(f"{path}/out/scored").select("batch").distinct().count() == 2


def test_score_job_keeps_invalid_rows(spark, fitted):
    rows = [POINT, {**POINT, "highway": "moonway"}, {**POINT, "weather_icon": None}, {**POINT, "Humidity_%": None}]
    messages = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    scored = score.scored_messages(messages, fitted, "keep")
    assert scored.count() == 4 and scored.filter("danger_index IS NULL").count() == 0
    known = score.scored_messages(messages.limit(1), fitted).first()["danger_index"]
    assert scored.filter("highway <> 'moonway' AND `Humidity(%)` IS NOT NULL AND Weather_Condition <> 'unknown'").first()["danger_index"] == known


def test_score_job_through_a_typed_table(spark, fitted):
    folder, path = scratch_path(spark, "topic"), scratch_path(spark, "scored")
    name = "scored_" + path.rsplit("-", 1)[1]

    def run(table):
        for stream in score.start(streams.read_messages(spark, "text", folder), fitted,
                                  f"{path}/out", f"{path}/checkpoint", "reject", table=table):
            stream.awaitTermination()

    send(spark, folder, POINT)
    run(name)
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["event_date", "batch"]
    assert spark.table(name).count() == 1
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (checked boolean)")
    send(spark, folder, {**POINT, "way_id": 2})
    run(name)
    rows = {r["way_id"]: r["checked"] for r in spark.table(name).collect()}
    assert rows == {POINT["way_id"]: None, 2: None}
    assert spark.table(name).filter("event_date = date'2024-07-25'").count() == 2
    run(name)
    assert spark.table(name).count() == 2

    def refused(columns, message):
        other = f"{name}_{len(columns)}"
        spark.sql(f"CREATE TABLE {other} ({columns}) USING parquet PARTITIONED BY (event_date, batch)"
                  f" LOCATION '{scratch_path(spark, 'other')}'")
        with pytest.raises(ValueError, match=message):
            run(other)

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in score.SCORED_TABLE.fields]
    refused(", ".join(columns).replace("danger_index` double", "danger_index` float"), "danger_index.* is float, not double")
    refused(", ".join(c for c in columns if "Stop" not in c), "Stop.* is missing")
    with pytest.raises(ValueError, match="partitioned by"):
        spark.sql(f"CREATE TABLE {name}_flat ({', '.join(columns)}) USING parquet LOCATION '{scratch_path(spark, 'flat')}'")
        run(f"{name}_flat")


def test_train_job_on_a_wide_file(spark):
    """46 columns in the public file's order, read by name; broken lines go aside with the reason."""
    rows = [{"Street": f"S{i % 7}", "Temperature(F)": 30.0 + i % 5, "Stop": i % 3 == 0} for i in range(60)]
    path, out = scratch_path(spark, "wide"), scratch_path(spark, "models")
    write_csv(wide(accidents(spark, *rows)).coalesce(2), f"{path}/accidents")
    part = sorted(Path(f"{path}/accidents").glob("part-*.csv"))[0]
    lines = part.read_text().splitlines()
    part.write_text("\n".join([*lines, lines[1] + ",x", lines[1].replace("30.0", "warm"), ""]))
    for crc in Path(f"{path}/accidents").glob(".part-*.crc"):
        crc.unlink()
    road = spark.createDataFrame([(f"S{i}", "Springfield", "Sangamon", "IL", f"h{i % 2}") for i in range(7)], ROADS)
    write_csv(road.select("highway", *[c for c in reversed(road.columns) if c != "highway"]), f"{path}/roads")
    fitted, version, _ = train.train_from_files(spark, f"{path}/accidents", f"{path}/roads", out, trees=2, depth=2)
    rejects = spark.read.json(f"{out}/{version}/rejects").collect()
    assert sorted(r["reason"] for r in rejects) == ["number of fields", "value of Temperature(F)"]
    assert set(fitted.stages[0].labelsArray[0]) == {"h0", "h1"}
    assert spark.read.parquet(f"{out}/{version}/training").agg(F.sum("count")).first()[0] == 60
