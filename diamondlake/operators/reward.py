"""Change of win expectancy as the reward of a plate appearance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from diamondlake.operators.columns import require_columns

REWARD = "reward_wpa_computed"


def add_reward(states: DataFrame) -> DataFrame:
    require_columns(states, ["we_before", "we_after", "reward_wpa"])
    return states.withColumn(REWARD, F.col("we_after") - F.col("we_before"))


def _faults() -> list[Column]:
    return [
        F.count_if(F.col(REWARD).isNull()).alias("missing"),
        F.count_if(~F.col(REWARD).between(-1.0, 1.0)).alias("outside"),
    ]


def _judged(missing: int, outside: int) -> int:
    if missing:
        raise ValueError(f"{REWARD} is missing on {missing} rows")
    return outside


def check_reward(rewards: DataFrame) -> int:
    """Raise when a reward is missing; return how many lie outside [-1, 1]."""
    row = rewards.agg(*_faults()).first()
    return _judged(row.missing, row.outside)


def checked(rewards: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """``rewards`` observed while they are written, and the check to call after that."""
    seen = Observation()
    return rewards.observe(seen, *_faults()), lambda: _judged(seen.get["missing"], seen.get["outside"])
