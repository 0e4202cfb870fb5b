"""Which sign convention does score_diff follow? Counts that tell, without changing data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.functions.state import base_digits
from diamondlake.operators.columns import percent_of_total
from diamondlake.operators.ordered import Order, neighbour

HALF = ["game_id", "inning", "home_or_away"]
MOVE_COLUMNS = [*HALF, "pa_seq", "score_diff", "pa_result"]


def widest_game(pa: DataFrame) -> DataFrame:
    """The game whose score moved most; the smallest id among equals."""
    spread = pa.groupBy("game_id").agg((F.max("score_diff") - F.min("score_diff")).alias("score_range"))
    return spread.orderBy(F.desc("score_range"), "game_id").limit(1)


def game_head_tail(pa: DataFrame, size: int = 30) -> DataFrame:
    """First and last rows of the widest game; the whole game when it has at most 2*size rows."""
    chosen = F.broadcast(widest_game(pa).select("game_id"))  # one row
    return head_tail(pa.join(chosen, "game_id", "left_semi"), size)


def head_tail(game: DataFrame, size: int = 30) -> DataFrame:
    """First and last rows of one game's plate appearances.

    Two top-k selections instead of a numbered window, so the game may be of any size.
    """
    game = game.select(
        "game_id", "pa_seq", "inning", "home_or_away", "out_count",
        base_digits(F.col("is_base1"), F.col("is_base2"), F.col("is_base3")).alias("base_state"),
        "score_diff", "pa_result",
    )
    order = ["inning", "home_or_away", "out_count", "pa_seq"]
    head = game.orderBy(*order).limit(size)
    tail = game.orderBy(*[F.desc(c) for c in order]).limit(size)
    return head.unionByName(tail).distinct()


def half_moves(pa: DataFrame, width: int | None = None) -> DataFrame:
    """Per half: did the score ever rise, did it ever fall."""
    order = Order(("game_id",), ("inning", "home_or_away", "pa_seq"), width)
    names = {"__inning": "inning", "__code": "home_or_away", "__score": "score_diff"}
    rows = neighbour(pa.select(*HALF, "pa_seq", "score_diff"), names, order, -1)
    same = (F.col("__inning") == F.col("inning")) & (F.col("__code") == F.col("home_or_away"))
    step = F.when(same, F.col("score_diff") - F.col("__score"))
    moved = rows.withColumn("step", step).groupBy(*HALF).agg(
        F.coalesce(F.bool_or(F.col("step") > 0), F.lit(False)).alias("any_up"),
        F.coalesce(F.bool_or(F.col("step") < 0), F.lit(False)).alias("any_down"),
    )
    return moved


def hypotheses(moves: DataFrame) -> DataFrame:
    """Halves that contradict each convention.

    H1 home - away, H2 batting - fielding, H3 away - home, H4 fielding - batting.
    The convention is the (last) one without a contradiction.
    """
    up, down = F.col("any_up"), F.col("any_down")
    home, away = F.col("home_or_away") == 1, F.col("home_or_away") == 0
    counts = moves.agg(
        F.count("*").alias("n_halves"),
        F.count_if((home & down) | (away & up)).alias("h1"),
        F.count_if(down).alias("h2"),
        F.count_if((away & down) | (home & up)).alias("h3"),
        F.count_if(up).alias("h4"),
    )
    winner = F.lit("UNKNOWN")
    for name in ("h1", "h2", "h3", "h4"):
        winner = F.when(F.col(name) == 0, name.upper()).otherwise(winner)
    return counts.withColumn("winner", winner).withColumn("fewest", F.least("h1", "h2", "h3", "h4"))


def violation_sample(pa: DataFrame, moves: DataFrame, halves: int = 3) -> DataFrame:
    """Rows of the first few halves in which the score fell."""
    return rows_of_halves(pa, first_violations(moves, halves))


def first_violations(moves: DataFrame, halves: int = 3) -> DataFrame:
    """The first few halves in which the score fell."""
    return moves.where("any_down").select(*HALF).orderBy(*HALF).limit(halves)


def rows_of_halves(pa: DataFrame, first: DataFrame) -> DataFrame:
    """Plate appearances of a few halves."""
    return pa.select(*MOVE_COLUMNS).join(F.broadcast(first), HALF, "left_semi")  # `halves` rows at most


def opening_plate_appearances(pa: DataFrame) -> DataFrame:
    """First plate appearance of each half of inning 1 with no out and empty bases."""
    empty = (F.col("is_base1") == 0) & (F.col("is_base2") == 0) & (F.col("is_base3") == 0)
    start = pa.where((F.col("inning") == 1) & (F.col("out_count") == 0) & empty)
    first = F.min_by(F.struct("score_diff", "pa_result"), "pa_seq").alias("first")
    return start.groupBy("game_id", "home_or_away").agg(first).select("game_id", "home_or_away", "first.*")


def opening_scores(pa: DataFrame) -> DataFrame:
    return opening_plate_appearances(pa).groupBy("score_diff").agg(F.count("*").alias("n"))


def nonzero_openings(pa: DataFrame, size: int = 10) -> DataFrame:
    odd = opening_plate_appearances(pa).where(F.col("score_diff") != 0)
    return odd.orderBy("game_id", "home_or_away").limit(size)


def half_code_share(pa: DataFrame) -> DataFrame:
    """Rows and percent per half code."""
    return percent_of_total(pa.groupBy("home_or_away").agg(F.count("*").alias("n")), "pct")


def half_order_check(pa: DataFrame) -> DataFrame:
    """Innings with both halves: does code 0 come before code 1?"""
    def first(code: int):
        return F.min(F.when(F.col("home_or_away") == code, F.col("pa_seq")))

    inning = pa.groupBy("game_id", "inning").agg(first(0).alias("top"), first(1).alias("bottom"))
    both = F.col("top").isNotNull() & F.col("bottom").isNotNull()
    return inning.agg(
        F.count_if(both).alias("n_both"),
        F.count_if(both & (F.col("top") < F.col("bottom"))).alias("order_ok"),
        F.count_if(both & (F.col("top") >= F.col("bottom"))).alias("order_fail"),
    )


def half_inning_check(states: DataFrame) -> DataFrame:
    """Games, rows, halves and half ends; the last two must agree."""
    one = states.agg(
        F.countDistinct("game_id").alias("n_games"), F.count("*").alias("n_rows"),
        F.countDistinct(F.struct(*HALF)).alias("n_halves"), F.count_if("inning_ended").alias("n_ended"),
    )
    return one.withColumn("halves_match", F.col("n_halves") == F.col("n_ended"))
