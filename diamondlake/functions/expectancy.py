"""Run and win expectancy as column expressions.

Both tables are fixed in size (24 and 288 cells), so they travel inside the
expression as literals: a lookup needs neither a join nor a broadcast and works
the same in batch and in streams.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import lru_cache
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

from diamondlake.functions.state import BOTTOM, SCORE_LIMIT, TOP, clamp, clip_score

# Base states in table order.
BASE_STATES = ["0", "1", "2", "3", "12", "13", "23", "123"]

# Expected runs by base state for 0, 1 and 2 outs
# (KJAS 29(2), 2016, table 2.1).
RUN_EXPECTANCY = {
    "0": [0.549, 0.267, 0.095],
    "1": [1.042, 0.556, 0.215],
    "2": [1.258, 0.700, 0.316],
    "3": [1.536, 1.042, 0.360],
    "12": [1.756, 0.972, 0.439],
    "13": [2.053, 1.342, 0.494],
    "23": [2.225, 1.490, 0.581],
    "123": [2.734, 1.662, 0.729],
}

HALVES = [TOP, BOTTOM]
ANCHOR_LOW, ANCHOR_HIGH = 3, 7
LAST_INNING = 12
WALK_OFF_INNING = 9


@dataclass(frozen=True)
class WinTable:
    """Win expectancy at the two anchor innings: (half, base, score) -> value."""

    low: tuple[tuple[tuple[str, str, int], float], ...]
    high: tuple[tuple[tuple[str, str, int], float], ...]


def load_win_table(path: str | None = None) -> WinTable:
    """Read the table (KJAS 29(2), 2016, table 3.2 by default) from a small CSV."""
    if path is None:
        text = resources.files("diamondlake.resources").joinpath("win_expectancy.csv").read_text("utf-8")
    else:
        with open(path, encoding="utf-8") as handle:
            text = handle.read()
    anchors: dict[int, list] = {ANCHOR_LOW: [], ANCHOR_HIGH: []}
    for inning, half, base, *values in csv.reader(text.splitlines()[1:]):
        for score, value in enumerate(values, -SCORE_LIMIT):
            anchors[int(inning)].append(((half, base, score), float(value)))
    return WinTable(*[tuple(cells) for cells in anchors.values()])


@lru_cache
def _win_array(table: WinTable | None) -> str:
    """SQL array over inning 3..7, half, base, score; slot 0 of half and base is 'unknown'."""
    table = table or load_win_table()
    low, high = dict(table.low), dict(table.high)
    values = []
    for inning in range(ANCHOR_LOW, ANCHOR_HIGH + 1):
        weight = (inning - ANCHOR_LOW) / (ANCHOR_HIGH - ANCHOR_LOW)
        for half in (None, *HALVES):
            for base in (None, *BASE_STATES):
                for score in range(-SCORE_LIMIT, SCORE_LIMIT + 1):
                    key = (half, base, score)
                    known = key in low and key in high
                    values.append(f"{(1.0 - weight) * low[key] + weight * high[key]!r}D" if known else "NULL")
    return f"array({', '.join(values)})"


@lru_cache
def _run_array() -> str:
    """SQL array over base and outs; slot 0 of the base is 'unknown'."""
    known = [f"{v!r}D" for base in BASE_STATES for v in RUN_EXPECTANCY[base]]
    return f"array(NULL, NULL, NULL, {', '.join(known)})"


def _slot(values: list[str], value: Column) -> Column:
    """1-based place of a text in a short list, 0 when it is not there."""
    return F.array_position(F.lit(values), value)


def run_expectancy(outs: Column, base: Column) -> Column:
    """Expected runs until the half ends; 0 from three outs on."""
    index = (_slot(BASE_STATES, base) * 3 + outs).cast("int")
    return F.when(outs >= 3, F.lit(0.0)).when(outs >= 0, F.get(F.expr(_run_array()), index))


def win_expectancy(
    inning: Column, half: Column, score: Column, base: Column, table: WinTable | None = None
) -> Column:
    """Win probability of the batting team.

    Constant up to inning 3 and from inning 7, linear in between; the score is
    clipped to +-4. An unknown part of the state gives NULL. Each input occurs
    once or twice, which keeps generated code small where lookups are nested.
    """
    step = clamp(inning, ANCHOR_LOW, ANCHOR_HIGH) - ANCHOR_LOW
    place = (step * (len(HALVES) + 1) + _slot(HALVES, half)) * (len(BASE_STATES) + 1) + _slot(BASE_STATES, base)
    index = place * (2 * SCORE_LIMIT + 1) + clip_score(score) + SCORE_LIMIT
    return F.get(F.expr(_win_array(table)), index.cast("int"))


def decided(score: Column) -> Column:
    """Value of a finished game: won 1, lost 0, drawn 0.5."""
    return (F.signum(score) + 1.0) / 2.0


def win_expectancy_with_end(
    inning: Column, half: Column, score: Column, outs: Column, base: Column, table: WinTable | None = None
) -> Column:
    """Win expectancy with the walk-off rule of inning 9 and the end of inning 12."""
    return (
        F.when((inning == WALK_OFF_INNING) & (half == BOTTOM) & (score > 0), F.lit(1.0))
        .when((inning >= LAST_INNING) & (outs >= 3), decided(score))
        .otherwise(win_expectancy(inning, half, score, base, table))
    )


def win_expectancy_out_adjusted(
    inning: Column, half: Column, score: Column, outs: Column, base: Column, alpha: float, table: WinTable | None = None
) -> Column:
    """Win expectancy shifted by alpha times the run-expectancy gap to one out, kept in [0, 1]."""
    shift = alpha * (run_expectancy(outs, base) - run_expectancy(F.lit(1), base))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), win_expectancy(inning, half, score, base, table) + shift))


def state_after(
    inning: Column, half: Column, score_after: Column, half_over: Column, next_outs: Column, next_base: Column
) -> dict[str, Column]:
    """The state whose expectancy tells the value after a plate appearance.

    Inside a half it is the next batter's state, otherwise the opponent's start
    of the following half.
    """
    top = half == TOP
    return {
        "after_inning": F.when(half_over & ~top, inning + 1).otherwise(inning),
        "after_half": F.when(~half_over, half).when(top, BOTTOM).otherwise(TOP),
        "after_score": F.when(half_over, -score_after).otherwise(score_after),
        "after_outs": F.when(half_over, F.lit(0)).otherwise(next_outs),
        "after_base": F.when(half_over, F.lit("0")).otherwise(next_base),
    }


def win_expectancy_after(
    inning: Column, half: Column, score_after: Column, half_over: Column, table: WinTable | None = None
) -> Column:
    """Win expectancy of the batting team once the plate appearance is over.

    Reads the columns of ``state_after``. At the end of a half it is one minus
    the opponent's expectancy, except for a walk-off in inning 9 and for games
    that end after inning 12.
    """
    q_inning = F.col("after_inning")
    we = win_expectancy_with_end(
        q_inning, F.col("after_half"), F.col("after_score"), F.col("after_outs"), F.col("after_base"), table
    )
    sign = F.when(half_over, F.lit(-1.0)).otherwise(F.lit(1.0))
    return (
        F.when(half_over & (half != TOP) & (inning == WALK_OFF_INNING) & (score_after > 0), F.lit(1.0))
        .when(half_over & (q_inning > LAST_INNING), decided(score_after))
        .otherwise(F.when(half_over, F.lit(1.0)).otherwise(F.lit(0.0)) + sign * we)
    )
