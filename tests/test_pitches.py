"""Relay JSON written by hand, conversions, labels, plate appearances."""

import json

import pytest
from pyspark.sql import functions as F

from diamondlake.functions import labels, parsing, state
from diamondlake.operators.plate_appearances import add_pitch_counts, add_recent_speed, aggregate_pa, assign_pa
from diamondlake.schemas import PITCH, RELAY_DOCUMENT
from diamondlake.sources import relay


def pitch(pitcher=1, batter=2, **more):
    state_part = {"pitcher": pitcher, "batter": batter, **more.pop("state", {})}
    return {"type": 1, "speed": 140, "pitchResult": "S", "currentGameState": state_part, **more}


def document(game, inning, relays):
    return (game, inning, json.dumps({"result": {"textRelayData": {"textRelays": relays}}}, ensure_ascii=False))


def parsed(spark, *documents):
    rows = relay.parse_pitches(spark.createDataFrame(list(documents), RELAY_DOCUMENT)).orderBy("game_id", "seq").collect()
    return rows


def test_order_newest_first_per_half(spark):
    relays = [
        {"homeOrAway": "1", "textOptions": [pitch(batter=4)]},
        {"homeOrAway": "0", "textOptions": [pitch(batter=2), pitch(batter=3)]},
        {"homeOrAway": "1", "textOptions": [pitch(batter=5)]},
        {"textOptions": [pitch(batter=1)]},
    ]
    rows = parsed(spark, document("g", 2, relays), document("g", 1, [{"homeOrAway": "1", "textOptions": [pitch(batter=9)]}]))
    assert [r.batter_id for r in rows] == [9, 1, 2, 3, 5, 4]
    assert [r.inning for r in rows] == [1, 2, 2, 2, 2, 2]
    assert [r.home_or_away for r in rows] == [1, 0, 0, 0, 1, 1]


def test_schema(spark):
    frame = relay.parse_pitches(spark.createDataFrame([document("g", 1, [{"textOptions": [pitch()]}])], RELAY_DOCUMENT))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in PITCH]


def test_pitch_filter_and_result_text(spark):
    options = [
        {"type": 8, "batterRecord": None},
        {"type": 8, "batterRecord": {"vsHra": 0.9}},
        {"type": 1, "currentGameState": {}},                      # no pitchResult key
        {"type": "1", "pitchResult": "S"},                        # kind as text
        {"type": 1, "pitchResult": None},
        {"type": 1, "pitchResult": ""},
        {"type": 1, "pitchResult": "None"},
        pitch(),
        {"type": 23, "text": None},
        {"type": 13, "text": "볼넷"},
    ]
    rows = parsed(spark, document("g", 1, [{"textOptions": options, "metricOption": {"wpaByPlate": -1.5}}]))
    assert [r.pitch_result for r in rows] == [None, None, None, "S"]
    assert {r.relay_text for r in rows} == {None} and {r.pitcher_vs_batter_avg for r in rows} == {0.0}
    assert {r.reward_wpa for r in rows} == {-1.5}


@pytest.mark.parametrize(
    ("today", "season", "want"),
    [(0, "0.3", 0.3), ("0.000", "0.3", 0.0), ("", 0.25, 0.25), (None, "-", 0.0), (0.4, "0.3", 0.4), (0.0, None, 0.0), ("x", 0.3, 0.0)],
)
def test_recent_average(spark, today, season, want):
    option = {"type": 8, "batterRecord": {"todayHra": today, "seasonHra": season, "hitType": "좌투좌타"}}
    (row,) = parsed(spark, document("g", 1, [{"textOptions": [option, pitch()]}]))
    assert row.batter_recent_avg == want and row.batter_hit_type == "L"


def test_defaults_and_numbers(spark):
    state_part = {"homeScore": "3", "awayScore": 5.9, "out": "1", "ball": None, "base1": "0", "base2": 7, "base3": "x"}
    (row,) = parsed(spark, document("g", 1, [{"inn": "4", "textOptions": [pitch(state=state_part, speed="n/a", stuff="")]}]))
    assert (row.inning, row.score_diff, row.out_count, row.ball_count_B, row.ball_count_S) == (4, -2, 1, None, 0)
    assert (row.is_base1, row.is_base2, row.is_base3) == (0, 1, 0)
    assert (row.pitch_speed, row.pitch_type, row.recent_5_pitch_speed_avg) == (None, None, None)


def test_unreadable_documents(spark):
    frame = spark.createDataFrame(
        [("a", 1, "{"), ("b", 1, "{}"), ("c", 1, '{"result": null}'), ("d", 1, '{"result": {"textRelayData": {"textRelays": {}}}}'),
         ("e", 1, None), document("f", 1, [{"textOptions": None}, {"textOptions": []}, {"textOptions": [pitch()], "inn": None}])],
        RELAY_DOCUMENT,
    )
    assert relay.parse_pitches(frame).isEmpty()
    assert relay.rejected_rows(relay.pitch_rows(frame)).count() == 1


def test_relay_values_once(spark):
    """What a relay says is read before its pitches are exploded, not once per pitch."""
    plan = relay.raw_pitches(spark.createDataFrame([], RELAY_DOCUMENT))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode(thrown", 1)
    assert "record" not in above and "vsHra" in below


def test_inning_cutoff(spark):
    some = [{"textOptions": [pitch()]}]
    rows = parsed(
        spark,
        *[document("a", i, [] if i in (1, 4) else some) for i in (1, 2, 3, 4, 5)],   # ends before 4, empty 1 is passed over
        *[document("b", i, some) for i in (1, 3, 12, 13)],                            # missing innings do not end it, 13 is never read
    )
    assert [(r.game_id, r.inning) for r in rows] == [("a", 2), ("a", 3), ("b", 1), ("b", 3), ("b", 12)]


def test_counters(spark):
    throws = [(1, None), (1, 150), (2, 130), (1, 151), (None, 100), (1, 152), (1, 153), (1, None), (1, 154), (1, 156), ("", 90)]
    options = [pitch(pitcher=p, speed=s) for p, s in throws]
    rows = parsed(spark, document("g", 1, [{"inn": 1, "textOptions": options}]), document("g", 2, [{"inn": 1, "textOptions": [pitch(1)]}]),
                  document("g", 3, [{"inn": 2, "textOptions": [pitch(1)]}]), document("g", 4, [{"inn": 1, "textOptions": [pitch(1)]}]))
    one = [r for r in rows if r.pitcher_id == 1]
    assert [r.total_pitch_count for r in one] == list(range(1, 12))
    assert [r.inning_pitch_count for r in one] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 1, 1]   # a return to inning 1 starts again
    assert [r.recent_5_pitch_speed_avg for r in one[:8]] == [None, 150.0, 150.5, 151.0, 151.5, None, 152.0, 153.2]
    unknown = [r for r in rows if r.pitcher_id is None]
    assert [r.total_pitch_count for r in unknown] == [1, 1]   # null and blank ids are two groups


def test_half_even_rounding(spark):
    rows = [("g", 1, 1, i, s) for i, s in enumerate([140.0, 140.0, 140.0, 140.5])]
    frame = spark.createDataFrame(rows, "game_id string, pitcher_id long, inning int, seq long, pitch_speed double")
    assert add_recent_speed(frame).where("seq = 3").first().recent_5_pitch_speed_avg == 140.12


def test_conversions(spark):
    texts = ["3", "0", "", "x", None, "0.5", "-2", " 4 ", "NaN", "1e2"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    rows = frame.select(parsing.base_flag(t).alias("b"), parsing.safe_number(t).alias("s"), parsing.nullable_number(t).alias("n")).collect()
    assert [r.b for r in rows] == [1, 0, 0, 0, 0, 0, 1, 1, 0, 0]
    assert [r.s for r in rows] == [3.0, 0.0, 0.0, 0.0, 0.0, 0.5, -2.0, 4.0, 0.0, 100.0]
    assert [r.n for r in rows] == [3.0, 0.0, None, None, None, 0.5, -2.0, 4.0, None, 100.0]


@pytest.mark.parametrize(
    ("text", "label"),
    [("최정 : 좌익수 앞 1루타", "1B"), ("김광현 : 헛스윙 삼진 아웃", "SO"), (None, "UNK"), ("", "UNK"), (" \t", "UNK"), ("기타", "UNK"),
     ("고의사구", "IBB"), ("사구", "HBP"), ("몸에 맞는 공", "HBP"), ("희생타", "SF"), ("2루수 병살타 아웃", "GDP"), ("아웃", "OUT"), ("3루타 홈런", "HR")],
)
def test_labels(spark, text, label):
    assert spark.createDataFrame([(text,)], "t string").select(labels.classify_result(F.col("t"))).first()[0] == label


@pytest.mark.parametrize(("text", "runs"), [("만루 홈런", 4), ("3점 홈런", 3), ("투런", 2), ("홈런", 1), ("12점 적시타", 12), ("땅볼", 0), (None, 0), (" ", 0)])
def test_runs_from_text(spark, text, runs):
    assert spark.createDataFrame([(text,)], "t string").select(labels.runs_from_text(F.col("t"))).first()[0] == runs


PITCHES = "game_id string, seq long, inning int, pitcher_id long, batter_id long, home_or_away int, score_diff int, pitch_result string, pitch_speed double, relay_text string, reward_wpa double"


def test_plate_appearances(spark):
    rows = [
        ("g", 1, 1, 5, 6, 0, None, "S", None, "볼넷", 1.0),
        ("g", 2, 1, 5, 6, 0, 2, None, 140.0, "볼넷", None),
        ("g", 3, 1, 7, 6, 0, 2, "S", 141.0, "볼넷", 2.0),      # new pitcher: a second plate appearance with the same label
        ("g", 4, 1, None, 6, 0, 2, "S", 142.0, "", None),      # unknown pitchers never continue one another
        ("g", 5, 1, None, 6, 0, 2, "S", 143.0, None, None),
        ("g", 6, 1, 5, 6, 0, 3, "S", 144.0, "홈런", None),     # same pair again later in the inning
        ("h", 1, 1, 5, 6, 0, 0, "S", 144.0, "홈런", None),
    ]
    numbered = assign_pa(spark.createDataFrame(rows, PITCHES))
    assert [(r.game_id, r.pa_seq) for r in numbered.orderBy("game_id", "seq").collect()] == [
        ("g", 1), ("g", 1), ("g", 2), ("g", 3), ("g", 4), ("g", 5), ("h", 1)
    ]
    got = {(r.game_id, r.pa_seq): r for r in aggregate_pa(numbered).collect()}
    first = got["g", 1]
    assert (first.score_diff, first.reward_wpa, first.pitches_per_pa, first.pa_avg_pitch_speed, first.pa_result) == (2, 1.0, 1, 140.0, "BB")
    assert [got["g", n].pa_result for n in (2, 3, 4, 5)] == ["BB", "UNK", "UNK", "HR"]


def test_absent_columns_are_left_out(spark):
    frame = spark.createDataFrame([("g", 1, 1, 5, 6)], "game_id string, seq long, inning int, pitcher_id long, batter_id long")
    got = aggregate_pa(assign_pa(add_pitch_counts(frame)))
    assert got.columns == ["game_id", "pa_seq", "inning", "pitcher_id", "batter_id", "total_pitch_count", "inning_pitch_count", "pa_result"]
    assert got.first().pa_result == "UNK"


def test_state_columns(spark):
    frame = spark.createDataFrame([("20240001HHSK02024", 1, 0, 1), ("20240001HHSK0", 0, 0, 0)], "g string, a int, b int, c int")
    bits = [F.col(c) for c in "abc"]
    rows = frame.select(state.base_state(*bits).alias("s"), state.base_digits(*bits).alias("d"), *state.game_id_parts(F.col("g"))).collect()
    assert [(r.s, r.d, r.season, r.game_number, r.away_team, r.home_team) for r in rows] == [
        ("13", "101", "2024", 0, "HH", "SK"), ("0", "000", None, 0, "HH", "SK")
    ]
