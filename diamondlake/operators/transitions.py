"""Plate appearances -> state before and after, runs and win expectancy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.functions.expectancy import WinTable, state_after, win_expectancy_after, win_expectancy_with_end
from diamondlake.functions.labels import CERTAIN_ZERO_LABELS, fallback_runs
from diamondlake.functions.state import attacker_score, base_state, half_number, half_of
from diamondlake.operators.columns import ratio, require_columns
from diamondlake.operators.ordered import Order, neighbour

NONZERO_START = "inning1_nonzero_start"
MANY_RUNS = "high_runs_scored_artifact"
MANY_RUNS_FROM = 5

NEEDED = ["game_id", "inning", "home_or_away", "pa_seq", "score_diff", "out_count", "is_base1", "is_base2", "is_base3", "pa_result"]
NEXT = {
    "next_inning": "inning", "next_code": "home_or_away", "next_score": "score_diff",
    "next_outs": "out_count", "next_base": "base_state",
}
WORKING = [
    *NEXT, "half_opened", "follows", "runs_guessed", "score_after",
    "after_inning", "after_half", "after_score", "after_outs", "after_base",
]


def add_before_state(pa: DataFrame, table: WinTable | None = None) -> DataFrame:
    """base_state, half, score of the batting team, win expectancy before."""
    bases = [F.col(f"is_base{n}") for n in (1, 2, 3)]
    states = pa.withColumns(
        {
            "base_state": base_state(*bases),
            "half": half_of(F.col("home_or_away")),
            "score_diff_attacker": attacker_score(F.col("score_diff"), F.col("home_or_away")),
        }
    )
    return states.withColumn(
        "we_before",
        win_expectancy_with_end(
            F.col("inning"), F.col("half"), F.col("score_diff_attacker"), F.col("out_count"), F.col("base_state"), table
        ),
    )


def _in_same_half(inning: str, code: str) -> Column:
    return F.coalesce((F.col(inning) == F.col("inning")) & (F.col(code) == F.col("home_or_away")), F.lit(False))


def add_neighbours(states: DataFrame, width: int | None = None) -> DataFrame:
    """State of the next plate appearance, and whether this one opens or ends its half.

    Ordered by inning, half and pa_seq, the row after the last one of a half is
    the first of the next half that was played. So a single ordering per game
    yields the next state inside a half and the opening score of the following
    half; ``follows`` tells when that half directly follows.
    """
    order = Order(("game_id",), ("inning", "home_or_away", "pa_seq"), width)
    after = neighbour(states, NEXT, order, 1)
    both = neighbour(after, {"prev_inning": "inning", "prev_code": "home_or_away"}, order, -1)
    here = half_number(F.col("inning"), F.col("home_or_away"))
    there = half_number(F.col("next_inning"), F.col("next_code"))
    return both.withColumns(
        {
            "inning_ended": ~_in_same_half("next_inning", "next_code"),
            "half_opened": ~_in_same_half("prev_inning", "prev_code"),
            "follows": F.coalesce(there == here + 1, F.lit(False)),
        }
    ).drop("prev_inning", "prev_code")


def add_runs(linked: DataFrame) -> DataFrame:
    """Runs of the plate appearance, and ``runs_guessed`` when only the label tells."""
    later = F.when(~F.col("inning_ended") | F.col("follows"), F.col("next_score"))
    sign = F.when(F.col("home_or_away") == 1, 1).otherwise(-1)
    gained = (later - F.col("score_diff")) * sign
    guess = fallback_runs(F.col("pa_result"), F.col("is_base1"), F.col("is_base2"), F.col("is_base3"))
    runs = F.coalesce(gained, F.when(F.col("inning_ended"), guess), F.lit(0))
    return linked.withColumns(
        {
            "runs_scored": F.greatest(runs, F.lit(0)).cast("int"),
            "runs_guessed": F.col("inning_ended") & gained.isNull(),
        }
    )


def add_after_state(scored: DataFrame, table: WinTable | None = None) -> DataFrame:
    now = [F.col("inning"), F.col("half"), F.col("score_after"), F.col("inning_ended")]
    after = scored.withColumn("score_after", F.col("score_diff_attacker") + F.col("runs_scored"))
    after = after.withColumns(state_after(*now, F.col("next_outs"), F.col("next_base")))
    return after.withColumn("we_after", win_expectancy_after(*now, table))


def quality_flag() -> Column:
    """'' for a clean row; an opening score other than 0 outranks a high run count."""
    opening = (F.col("inning") == 1) & F.col("half_opened") & (F.col("score_diff") != 0)
    return (
        F.when(opening, NONZERO_START).when(F.col("runs_scored") >= MANY_RUNS_FROM, MANY_RUNS).otherwise("")
    )


def link_transitions(pa: DataFrame, table: WinTable | None = None, width: int | None = None) -> DataFrame:
    """State columns with the working columns (next state, opened, guessed) kept."""
    require_columns(pa, NEEDED)
    linked = add_neighbours(add_before_state(pa, table), width)
    return add_after_state(add_runs(linked), table).withColumn("data_quality_flag", quality_flag())


def transitions(pa: DataFrame, table: WinTable | None = None, width: int | None = None) -> DataFrame:
    """Plate appearances plus base_state, half, score, runs, win expectancy and flag."""
    return link_transitions(pa, table, width).drop(*WORKING)


def fallback_rate(linked: DataFrame) -> DataFrame:
    """How often runs had to be guessed, and how often the guess of 0 is doubtful."""
    guessed = F.col("runs_guessed")
    doubtful = guessed & (F.col("runs_scored") == 0) & ~F.col("pa_result").isin(CERTAIN_ZERO_LABELS)
    counts = linked.agg(F.count_if(guessed).alias("n_fallback"), F.count_if(doubtful).alias("n_doubtful"))
    rate = F.coalesce(ratio(F.col("n_doubtful"), F.col("n_fallback")), F.lit(0.0))
    return counts.withColumn("doubtful_rate", rate).withColumn("alarm", rate > 0.1)


def state_checks(states: DataFrame) -> DataFrame:
    """Row count, missing values, halves against half ends, range of both expectancies."""
    half = F.struct("game_id", "inning", "home_or_away")
    outside = [F.count_if(~F.col(c).between(0.0, 1.0)).alias(f"{c}_outside") for c in ("we_before", "we_after")]
    missing = [F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in ("we_before", "we_after", "runs_scored")]
    return states.agg(
        F.count("*").alias("n_rows"), *missing, *outside,
        F.count_if(F.col("runs_scored") < 0).alias("negative_runs"),
        F.countDistinct(half).alias("n_halves"), F.count_if("inning_ended").alias("n_ended"),
        F.count_if(F.col("data_quality_flag") == NONZERO_START).alias("n_nonzero_start"),
    )
