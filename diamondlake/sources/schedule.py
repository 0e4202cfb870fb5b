"""Schedule documents, game-id lists and month windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The pair of teams, the state of a finished game, the months played.
TARGET_TEAMS = ("HH", "SK")
FINISHED = "RESULT"
FIRST_MONTH, LAST_MONTH = 3, 11
FIRST_YEAR, LAST_YEAR = 2015, 2024
EMPTY_JSON = ["null", "{}", "[]", '""', "0", "false"]


def schedule_games(documents: DataFrame) -> DataFrame:
    """One row per listed game. The list sits under ``result`` or at the top level."""
    root = F.try_parse_json("payload")
    result = F.coalesce(F.to_json(F.try_variant_get(root, "$.result", "variant")), F.lit("null"))
    games = F.when(
        result.isin(EMPTY_JSON), F.try_variant_get(root, "$.games", "array<variant>")
    ).otherwise(F.try_variant_get(root, "$.result.games", "array<variant>"))
    game = documents.select(F.explode(games).alias("game"))

    def text(name: str) -> Column:
        return F.coalesce(F.try_variant_get("game", f"$.{name}", "string"), F.lit(""))

    return game.select(
        text("gameId").alias("game_id"), text("homeTeamCode").alias("home"), text("awayTeamCode").alias("away"),
        text("statusCode").alias("status"),
        F.coalesce(F.try_variant_get("game", "$.cancel", "boolean"), F.lit(False)).alias("cancelled"),
    )


def target_game_ids(documents: DataFrame, teams: Sequence[str] = TARGET_TEAMS) -> DataFrame:
    """Distinct ids of finished, not cancelled games between the two teams."""
    games = schedule_games(documents)
    pair = F.array_sort(F.array("home", "away")) == F.array(*[F.lit(t) for t in sorted(teams)])
    wanted = (F.col("game_id") != "") & (F.col("status") == FINISHED) & ~F.col("cancelled") & pair
    return games.where(wanted).select("game_id").distinct()


def write_id_list(ids: DataFrame, path: str) -> None:
    """Sorted text, one id per line; part files follow the order."""
    ids.select("game_id").distinct().orderBy("game_id").write.mode("overwrite").text(path)


def clean_id_lines(lines: DataFrame) -> DataFrame:
    """Trimmed ids without blank lines."""
    trimmed = lines.select(F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("game_id"))
    return trimmed.where(F.col("game_id") != "")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    return clean_id_lines(spark.read.text(path))


def month_window(date: Column) -> list[Column]:
    """First and last day of the month of a date."""
    return [F.trunc(date, "month").alias("first_day"), F.last_day(date).alias("last_day")]


def month_windows(spark: SparkSession, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """All months of the season to ask the schedule for."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    months = years.select(
        "year", F.explode(F.sequence(F.lit(FIRST_MONTH), F.lit(LAST_MONTH))).alias("month")
    )
    return months.select("year", "month", *month_window(F.make_date("year", "month", F.lit(1))))


def only_listed(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the listed games."""
    return rows.join(ids.select("game_id"), "game_id", "left_semi")


def not_done(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of games that have not been processed yet."""
    return rows.join(done.select("game_id"), "game_id", "left_anti")
