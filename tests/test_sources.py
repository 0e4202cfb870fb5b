"""Files in and out: layers, CSV, id lists, schedules, the chained jobs, the stream."""

import json

import pytest
from compare import bag
from pyspark.sql import functions as F

from diamondlake.operators.columns import order_columns
from diamondlake.plans import jobs, relay_view
from diamondlake.plans import pitch_view as view
from diamondlake.operators.plate_appearances import add_pitch_counts, add_recent_speed
from diamondlake.schemas import PITCH
from diamondlake.sources import layers, relay, schedule
from diamondlake.streaming import incremental


def same(a, b):
    one, two = bag(a.columns, a.collect()), bag(b.columns, b.collect())
    assert sorted(a.columns) == sorted(b.columns) and one == two and one


@pytest.fixture(scope="module")
def pitches(spark, small):
    return add_recent_speed(add_pitch_counts(view.pitch_view(spark, small))).select(*PITCH.names).cache()


def test_csv_files(spark, pitches, tmp_path):
    path = str(tmp_path / "csv")
    layers.write_csv(pitches, path)
    back = layers.read_csv(spark, path)
    assert back.schema == PITCH
    same(back, layers.csv_round_trip(pitches, str(tmp_path / "again")))
    same(back, pitches.withColumn("relay_text", F.nullif("relay_text", F.lit(""))))


def test_csv_with_mark_missing_words_and_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("inning,game_id,pitcher_id,total_pitch_count,relay_text\n3,g1,None,7.0,NA\n", encoding="utf-8-sig")
    (tmp_path / "b.csv").write_text("inning,game_id,pitcher_id,total_pitch_count,relay_text\n4,g2,9007199254740993,,아웃\n", encoding="utf-8-sig")
    schema = type(PITCH)([PITCH[n] for n in ("inning", "game_id", "pitcher_id", "total_pitch_count", "relay_text")])
    rows = layers.read_csv(spark, str(tmp_path), schema).orderBy("game_id").collect()
    assert [tuple(r) for r in rows] == [(3, "g1", None, 7, None), (4, "g2", 9007199254740993, None, "아웃")]


def test_no_csv_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        layers.read_csv(spark, str(tmp_path))


def test_layer_by_season(spark, pitches, tmp_path):
    path = str(tmp_path / "pitches")
    layers.write_layer(pitches, path)
    assert (tmp_path / "pitches" / "season=2016").is_dir()
    same(layers.read_layer(spark, path).select(*PITCH.names), pitches)


def test_column_order(pitches):
    mixed = pitches.select("seq", "reward_wpa", F.lit(1).alias("extra"), "game_id")
    assert order_columns(mixed, PITCH.names[:-1]).columns == ["game_id", "reward_wpa", "seq", "extra"]


def test_id_list(spark, tmp_path):
    path = str(tmp_path / "ids")
    ids = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "game_id string")
    schedule.write_id_list(ids, path)
    lines = [line for part in sorted((tmp_path / "ids").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines == ["a", "b", "c"]
    (tmp_path / "more.txt").write_text(" x1 \r\n\n\t\ny2　\n")
    assert [r.game_id for r in schedule.read_id_list(spark, str(tmp_path / "more.txt")).collect()] == ["x1", "y2"]


def test_schedule(spark):
    def game(i, home, away, status="RESULT", **more):
        return {"gameId": i, "homeTeamCode": home, "awayTeamCode": away, "statusCode": status, **more}

    good = [game("g1", "HH", "SK"), game("g2", "SK", "HH", cancel=False)]
    bad = [game("g3", "HH", "HH"), game("g4", "HH", "LG"), game("g5", "HH", "SK", "BEFORE"), game("g6", "HH", "SK", cancel=True),
           game("", "HH", "SK"), game(None, "HH", "SK"), {"gameId": "g7"}]
    payloads = [{"result": {"games": good[:1] + bad}}, {"games": good}, {"result": {}, "games": good}, {"result": {"games": None}},
                {"result": {"other": 1}, "games": [game("g8", "HH", "SK")]}]
    frame = spark.createDataFrame([(json.dumps(p),) for p in payloads] + [("broken",)], "payload string")
    assert sorted(r.game_id for r in schedule.target_game_ids(frame).collect()) == ["g1", "g2"]
    assert [r.game_id for r in schedule.target_game_ids(frame, ("LG", "HH")).collect()] == ["g4"]


def test_month_windows(spark):
    rows = schedule.month_windows(spark).collect()
    assert len(rows) == 90 and {r.month for r in rows} == set(range(3, 12))
    assert [str(r.last_day) for r in rows if (r.year, r.month) in ((2016, 4), (2024, 3))] == ["2016-04-30", "2024-03-31"]


def test_raw_payload_files(spark, tmp_path):
    (tmp_path / "20240001HHSK02024_7.json").write_text('{\n "result": {"textRelayData": {"textRelays": []}}\n}')
    (row,) = relay.read_relay_folder(spark, str(tmp_path)).collect()
    assert (row.game_id, row.req_inning) == ("20240001HHSK02024", 7) and row.payload.startswith("{\n")


def test_jobs(spark, small, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "run")
    documents = relay_view.relay_documents(spark, small)
    documents.write.json(landed)
    ids = documents.select("game_id").distinct().where("substring(game_id, 1, 4) <> '2018'")
    made = jobs.run(spark, landed, root, ids, limit=60)
    listed = schedule.only_listed(documents, ids)
    expected = relay.parse_pitches(listed)
    stored = layers.read_pitch_layer(spark, made.path("pitches"))
    same(stored.select(*PITCH.names), expected)
    rejects = layers.read_pitch_layer(spark, made.path("pitches"), layers.REJECTS)
    broken = rejects.where("reason = 'payload'")
    assert rejects.count() - broken.count() >= relay.rejected_rows(relay.pitch_rows(listed)).count() > 0
    assert broken.count() == listed.where("payload is null or try_parse_json(payload) is null").count() > 0
    rewards = layers.read_layer(spark, made.path("rewards"))
    assert rewards.count() == layers.read_layer(spark, made.path("plate_appearances")).count() > 0
    assert rewards.where("abs(reward_wpa_computed - (we_after - we_before)) > 1e-12").isEmpty()
    assert {r.section for r in spark.read.json(made.path("report")).select("section").distinct().collect()} == {
        "figures", "label_mean", "label_n", "season", "provider", "flag_n", "flag_mean", "flag_std", "mismatch", "criterion", "passed", "conclusion"
    }
    assert layers.read_layer(spark, made.path("training_set")).where("batter_recent_avg is null").isEmpty()
    # A second run skips the games that are there and adds the rest.
    jobs.run(spark, landed, root, limit=60)
    before = layers.read_layer(spark, made.path("pitches")).count()
    same(layers.read_pitch_layer(spark, made.path("pitches")).select(*PITCH.names), relay.parse_pitches(documents))
    jobs.run(spark, landed, root, limit=60)
    assert layers.read_layer(spark, made.path("pitches")).count() == before


def test_stream(spark, small, tmp_path):
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))
    documents = relay_view.relay_documents(spark, small).cache()
    games = [r.game_id for r in documents.select("game_id").distinct().orderBy("game_id").collect()]

    def land(ids):
        documents.where(F.col("game_id").isin(ids)).coalesce(1).write.mode("append").json(landed)

    def catch_up():
        incremental.start_pitch_stream(spark, landed, out, checkpoint, 1).awaitTermination()
        return incremental.read_pitches(spark, out)

    land(games[:5])
    same(catch_up(), relay.parse_pitches(documents.where(F.col("game_id").isin(games[:5]))))
    land(games[3:9])   # two of them again
    land(games[9:])
    got = catch_up()
    same(got, relay.parse_pitches(documents))
    # A repeated batch replaces its own folder.
    incremental.store_batch(documents.where(F.col("game_id").isin(games[3:9])), 1, out)
    same(incremental.read_pitches(spark, out), relay.parse_pitches(documents))


def test_stream_of_single_innings(spark, small, tmp_path):
    """Innings of one game in several batches, an empty one before and after its game's others."""
    documents = relay_view.relay_documents(spark, small).cache()
    out = str(tmp_path / "out")
    parts = ("req_inning in (2, 5, 6, 9)", "req_inning in (1, 3)", "req_inning in (4, 7, 8)", "req_inning > 9")
    for batch, part in enumerate(parts):
        incremental.store_batch(documents.where(part), batch, out)
    same(incremental.read_pitches(spark, out), relay.parse_pitches(documents))
    rejects = relay.rejects_of(relay.cut_after_end(relay.raw_pitches(documents)))
    assert incremental.read_rejects(spark, out).count() == rejects.count() > 0


def test_unreadable_inning(spark):
    """An inning that is no JSON, or missing, is set aside; the game goes on. An empty one ends it."""
    option = {"type": 1, "pitchResult": "S", "currentGameState": {"pitcher": "1", "batter": "2"}}

    def payload(n):
        return json.dumps({"result": {"textRelayData": {"textRelays": [{"homeOrAway": "0", "inn": n, "textOptions": [option]}]}}})

    rows = [("g", n, payload(n)) for n in range(1, 10)] + [("h", 1, payload(1)), ("h", 2, '{"result":{}}'), ("h", 3, payload(3)), ("g", 13, payload(13))]
    rows[2], rows[4] = ("g", 3, payload(3)[:40]), ("g", 5, None)
    frame = spark.createDataFrame(rows, "game_id string, req_inning int, payload string")
    got = sorted((r.game_id, r.inning) for r in relay.parse_pitches(frame).collect())
    assert got == [("g", n) for n in (1, 2, 4, 6, 7, 8, 9)] + [("h", 1)]
    set_aside = relay.rejects_of(relay.cut_after_end(relay.raw_pitches(frame))).select("req_inning", "reason").collect()
    assert sorted(map(tuple, set_aside)) == [(3, "payload"), (5, "payload"), (13, "inning")]
    twice = spark.createDataFrame([*rows, ("g", 3, payload(3)), ("g", 1, "x"), ("g", None, "y")], frame.schema)
    assert relay.latest_documents(twice).where("game_id = 'g' and req_inning = 3").first().payload == payload(3)
    assert relay.latest_documents(twice).count() == len(rows) + 1


def test_half_order_by_full_code(spark):
    """Halves are ordered by their whole code text."""
    option = {"type": 1, "pitchResult": "S", "currentGameState": {"pitcher": "1", "batter": "2"}}
    listed = [{"homeOrAway": code, "inn": 1, "textOptions": [{**option, "speed": str(i)}]} for i, code in enumerate(["10", "1", "100", "2"])]
    frame = spark.createDataFrame([("g", 1, json.dumps({"result": {"textRelayData": {"textRelays": listed}}}))], "game_id string, req_inning int, payload string")
    assert [r.home_or_away for r in relay.parse_pitches(frame).orderBy("seq").collect()] == [1, 10, 100, 2]


def test_csv_by_name(spark, tmp_path):
    """Files of any column order, without ``seq``, with a quoted line break; one without the game column is listed."""
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text("game_id,inning,pitch_type\ng1,3,FAST\ng1,4,\n", encoding="utf-8-sig")
    (tmp_path / "two.csv").write_text("extra,inning,game_id\nx,7,g2\n")
    (tmp_path / "bad.csv").write_text("no,header\n1,2\n")
    rows = layers.read_csv(spark, str(tmp_path)).orderBy("game_id", "seq").collect()
    assert [(r.game_id, r.inning, r.pitch_type) for r in rows] == [("g1", 3, "FAST"), ("g1", 4, None), ("g2", 7, None)]
    assert rows[0].seq < rows[1].seq and layers.read_csv(spark, str(tmp_path)).schema == PITCH
    assert [r.file.rsplit("/", 1)[1] for r in layers.skipped_csv(spark, str(tmp_path)).collect()] == ["bad.csv"]


def test_csv_of_many_columns(spark, tmp_path):
    """70 columns and the game column last, repeated and empty names, a second header; where a game lies."""
    names = [f"c{i}" for i in range(66)] + ["c1", "", "inning", "game_id"]
    lines = [",".join(names), *(",".join([*map(str, range(68)), str(n), f"g{n % 2}"]) for n in range(1, 5))]
    (tmp_path / "wide one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "narrow.csv").write_text("game_id,inning\ng0,9\n")
    rows = layers.read_csv(spark, str(tmp_path)).collect()
    assert sorted((r.game_id, r.inning) for r in rows) == [("g0", 2), ("g0", 4), ("g0", 9), ("g1", 1), ("g1", 3)]
    index = layers.csv_index(spark, str(tmp_path)).collect()
    assert sorted((r.game_id, r.file.rsplit("/", 1)[1], r.n_rows) for r in index) == [
        ("g0", "narrow.csv", 1), ("g0", "wide%20one.csv", 2), ("g1", "wide%20one.csv", 2)]


def test_csv_files_do_not_grow_with_games(spark, tmp_path):
    rows = spark.range(3000).selectExpr("concat('2024', id) AS game_id", "1 AS inning", "id AS seq")
    layers.write_csv(rows, str(tmp_path / "csv"))
    assert 0 < len(list((tmp_path / "csv").glob("*.csv"))) <= 8
    assert layers.read_csv(spark, str(tmp_path / "csv")).count() == 3000
