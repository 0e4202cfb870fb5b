"""One declared schema per layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the pitch table.
PITCH_COLUMNS = [
    "game_id", "inning", "home_or_away",
    "score_diff", "out_count", "ball_count_B", "ball_count_S",
    "is_base1", "is_base2", "is_base3",
    "pitcher_id", "batter_id", "batter_hit_type",
    "pitcher_vs_batter_avg", "batter_recent_avg",
    "pitch_speed", "pitch_type",
    "total_pitch_count", "recent_5_pitch_speed_avg", "inning_pitch_count",
    "pitch_result", "relay_text", "reward_wpa",
]
_TEXT = {"game_id", "batter_hit_type", "pitch_type", "pitch_result", "relay_text"}
_LONG = {"pitcher_id", "batter_id", "seq"}
_DOUBLE = {"pitcher_vs_batter_avg", "batter_recent_avg", "pitch_speed", "recent_5_pitch_speed_avg", "reward_wpa"}


def _type_of(name: str) -> T.DataType:
    if name in _TEXT:
        return T.StringType()
    if name in _LONG:
        return T.LongType()
    return T.DoubleType() if name in _DOUBLE else T.IntegerType()


PITCH = T.StructType([T.StructField(name, _type_of(name)) for name in [*PITCH_COLUMNS, "seq"]])

# One landed relay document: a game, the inning it was asked for, the raw JSON.
RELAY_DOCUMENT = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("req_inning", T.IntegerType()),
        T.StructField("payload", T.StringType()),
    ]
)
