"""Game-state columns: half, base code, score from the batting side, game id parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOP, BOTTOM = "top", "bot"
SCORE_LIMIT = 4


def half_of(code: Column) -> Column:
    """0 -> top, 1 -> bot, anything else NULL."""
    return F.when(code == 0, TOP).when(code == 1, BOTTOM)


def attacker_score(score_diff: Column, code: Column) -> Column:
    """Home-minus-away score seen from the team at bat."""
    return F.when(code == 1, score_diff).otherwise(-score_diff).cast("int")


def base_state(base1: Column, base2: Column, base3: Column) -> Column:
    """'0', '1', '2', '3', '12', '13', '23' or '123'."""
    digits = F.concat(
        *[F.when(flag != 0, str(n)).otherwise("") for n, flag in ((1, base1), (2, base2), (3, base3))]
    )
    return F.when(digits == "", "0").otherwise(digits)


def base_digits(base1: Column, base2: Column, base3: Column) -> Column:
    """Three-digit base code '000' .. '111'."""
    return F.concat(*[flag.cast("string") for flag in (base1, base2, base3)])


def clamp(value: Column, low: int, high: int) -> Column:
    """Value kept inside low..high; NULL stays NULL (least and greatest alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def clip_score(score: Column, limit: int = SCORE_LIMIT) -> Column:
    return clamp(score, -limit, limit)


def half_number(inning: Column, code: Column) -> Column:
    """Halves counted through a game; the following half is this plus one."""
    return inning * 2 + code


def season_of(game_id: Column) -> Column:
    return F.substring(game_id, 1, 4)


def game_id_parts(game_id: Column) -> list[Column]:
    """Date, away team, home team, game number and season (absent in the short form)."""
    return [
        F.try_to_date(F.substring(game_id, 1, 8), "yyyyMMdd").alias("game_date"),
        F.substring(game_id, 9, 2).alias("away_team"),
        F.substring(game_id, 11, 2).alias("home_team"),
        F.substring(game_id, 13, 1).try_cast("int").alias("game_number"),
        F.nullif(F.substring(game_id, 14, 4), F.lit("")).alias("season"),
    ]
