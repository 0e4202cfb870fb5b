"""Model-ready table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.operators.columns import require_columns
from diamondlake.operators.profile import clean
from diamondlake.operators.reward import REWARD

# Features, targets and fill values of the training table.
FEATURES = [
    "inning", "half", "score_diff_attacker", "base_state", "out_count", "total_pitch_count",
    "inning_pitch_count", "batter_hit_type", "pitcher_vs_batter_avg", "batter_recent_avg",
    "pitcher_id", "batter_id",
]
TARGETS = ["pa_result", REWARD]
AVERAGE_FILL = 0.250
SPEED_FILL = 131.0
LAST_REGULAR_INNING = 9
AVERAGES = ["pitcher_vs_batter_avg", "batter_recent_avg"]
COUNTS = ["inning", "score_diff_attacker", "out_count", "total_pitch_count", "inning_pitch_count"]


def training_set(
    rewards: DataFrame,
    average_fill: float | None = AVERAGE_FILL,
    regular_only: bool = False,
    with_speed: bool = False,
) -> DataFrame:
    """Clean rows with features, targets and keys.

    ``average_fill=None`` leaves unknown averages to the model. ``with_speed``
    adds the mean speed, where 0 and unknown become the league mean, and a flag.
    """
    require_columns(rewards, [*FEATURES, *TARGETS, "data_quality_flag"])
    rows = clean(rewards)
    if regular_only:
        rows = rows.where(F.col("inning") <= LAST_REGULAR_INNING)
    columns = ["game_id", "pa_seq", *FEATURES, *TARGETS]
    if with_speed:
        unknown = F.coalesce(F.col("pa_avg_pitch_speed") == 0, F.lit(True))
        rows = rows.withColumn("speed_missing", unknown).withColumn(
            "pa_avg_pitch_speed", F.when(unknown, F.lit(SPEED_FILL)).otherwise(F.col("pa_avg_pitch_speed"))
        )
        columns += ["pa_avg_pitch_speed", "speed_missing"]
    fills: dict[str, float | int] = dict.fromkeys(COUNTS, 0)
    if average_fill is not None:
        fills |= dict.fromkeys(AVERAGES, average_fill)
    return rows.select(*columns).fillna(fills)
