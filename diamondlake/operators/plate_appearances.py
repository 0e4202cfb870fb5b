"""Pitches -> plate appearances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.functions.labels import LABEL_ORDER, classify_result, label_rank
from diamondlake.operators.ordered import Order, neighbour, position, rolling_mean, running

PA_KEY = ("inning", "pitcher_id", "batter_id")

# Columns whose first known value describes the plate appearance.
FIRST_COLUMNS = [
    "inning", "home_or_away", "pitcher_id", "batter_id", "batter_hit_type",
    "pitcher_vs_batter_avg", "batter_recent_avg", "score_diff", "out_count",
    "is_base1", "is_base2", "is_base3", "total_pitch_count", "inning_pitch_count",
]
LAST_COLUMNS = ["pa_result", "reward_wpa"]


def assign_pa(pitches: DataFrame, width: int | None = None) -> DataFrame:
    """Number plate appearances inside each game as ``pa_seq``.

    A new one starts when inning, pitcher or batter differs from the previous
    pitch. An unknown value differs from everything, another unknown included.
    """
    order = Order(("game_id",), ("seq",), width)
    shifted = neighbour(pitches, {f"__prev_{c}": c for c in PA_KEY}, order, -1)
    changed = F.lit(False)
    for c in PA_KEY:
        changed = changed | (F.col(c) != F.col(f"__prev_{c}"))
    starts = shifted.withColumn("__starts", F.coalesce(changed, F.lit(True)).cast("bigint"))
    numbered = running(starts, "pa_seq", F.col("__starts"), order)
    return numbered.drop("__starts", *[f"__prev_{c}" for c in PA_KEY])


def add_pitch_counts(pitches: DataFrame, pitcher: str = "pitcher_id", width: int | None = None) -> DataFrame:
    """Pitch number of the pitcher in the game and since the pitcher's last change of inning."""
    order = Order(("game_id", pitcher), ("seq",), width)
    counted = position(pitches, "__count", order)
    shifted = neighbour(counted, {"__prev_inning": "inning"}, order, -1)
    begin = F.when(F.coalesce(F.col("inning") != F.col("__prev_inning"), F.lit(True)), F.col("__count"))
    begun = running(shifted.withColumn("__begin", begin), "__since", F.col("__begin"), order, "max")
    return begun.withColumns(
        {
            "total_pitch_count": F.col("__count").cast("int"),
            "inning_pitch_count": (F.col("__count") - F.col("__since") + 1).cast("int"),
        }
    ).drop("__count", "__prev_inning", "__begin", "__since")


def add_recent_speed(
    pitches: DataFrame, pitcher: str = "pitcher_id", width: int | None = None, size: int = 5
) -> DataFrame:
    """Mean speed of the pitcher's last five known pitches, half-even to two digits."""
    order = Order(("game_id", pitcher), ("seq",), width)
    meaned = rolling_mean(pitches, "__mean", "pitch_speed", order, size)
    return meaned.withColumn("recent_5_pitch_speed_avg", F.bround("__mean", 2)).drop("__mean")


def _known(value: Column, pick, alias: str) -> Column:
    return pick(value, F.when(value.isNotNull(), F.col("seq"))).alias(alias)


def aggregate_pa(pitches: DataFrame) -> DataFrame:
    """One row per (game_id, pa_seq). Columns the input lacks are left out.

    Everything is a partial aggregate, so a plate appearance of any size is
    combined before it moves. After ``assign_pa`` the rows already lie by game
    and no further exchange is planned. The label is folded as its rank.
    """
    have = set(pitches.columns)
    label = classify_result(F.col("relay_text") if "relay_text" in have else F.lit(""))
    rows = pitches.withColumn("pa_result", label_rank(label))
    columns = [_known(F.col(c), F.min_by, c) for c in FIRST_COLUMNS if c in have]
    columns += [_known(F.col(c), F.max_by, c) for c in LAST_COLUMNS if c in (*have, "pa_result")]
    if "pitch_result" in have:
        columns.append(F.count("pitch_result").alias("pitches_per_pa"))
    if "pitch_speed" in have:
        columns.append(F.avg("pitch_speed").alias("pa_avg_pitch_speed"))
    folded = rows.groupBy("game_id", "pa_seq").agg(*columns)
    return folded.withColumn("pa_result", F.element_at(F.lit(LABEL_ORDER), F.col("pa_result")))


def plate_appearances(pitches: DataFrame, width: int | None = None) -> DataFrame:
    """Pitches with counters -> plate appearances."""
    return aggregate_pa(assign_pa(pitches, width))
