"""Pitch rows derived from the order tables.

One order is a plate appearance, one line of it a pitch, 72 consecutive order
keys a game. Labels, bases, scores, missing values and pitching changes follow
from the keys by arithmetic, so the same rows can be derived in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from diamondlake.operators.ordered import CHUNK_WIDTH, HOT_LIMIT, Order, branches, deal, find_hot, position, union

ORDERS_PER_GAME = 72
GAME_ID = (
    "concat(cast((2016 + g % 9) * 10000 + floor(g / 9) as string),"
    " case when g % 5 = 0 then 'LGOB' when g % 2 = 0 then 'SKHH' else 'HHSK' end,"
    " '0', cast(2016 + g % 9 as string))"
)
# Position of the pitch inside a game: place of the order, then of the line.
SEQ_STEP = 1_000_000_000_000
LINE_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hot_games(spark: SparkSession, sf_dir: str, limit: int = HOT_LIMIT) -> DataFrame | None:
    """Games with too many pitches for one task, by their row counts."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr(f"cast(floor(l_orderkey / {ORDERS_PER_GAME}) as bigint)").alias("g")
    )
    found = find_hot(lines, "g", limit)
    return None if found is None else found.select("g", F.expr(GAME_ID).alias("game_id"))


def plate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its game, place and score.

    The score window spans one game, which holds at most 72 distinct order keys.
    """
    rows = table(spark, sf_dir, "orders")
    orders = rows.selectExpr(
        "o_orderkey", "o_custkey",
        f"cast(floor(o_orderkey / {ORDERS_PER_GAME}) as bigint) as g",
        f"cast(o_orderkey % {ORDERS_PER_GAME} as bigint) as p",
    )
    orders = deal(orders, rows.count(), "g")
    placed = orders.selectExpr(
        "*",
        "cast(1 + floor(p / 8) + case when g % 17 = 1 then 3 else 0 end as int) as inning",
        "cast(floor(p / 4) % 2 as int) as home_or_away",
        "cast(p % 4 as int) as b",
        "case when o_custkey % 500 = 3 then 6 when o_custkey % 20 = 0 then 1"
        " when o_custkey % 20 = 1 then 2 else 0 end as r",
    )
    before = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    scored = F.coalesce(F.sum(F.expr("case when home_or_away = 1 then r else -r end")).over(before), F.lit(0))
    return placed.withColumn("score_diff", (scored + F.expr("case when g % 13 = 0 then 1 else 0 end")).cast("int"))


def pitch_view(spark: SparkSession, sf_dir: str, limit: int = HOT_LIMIT, width: int = CHUNK_WIDTH) -> DataFrame:
    """The pitch rows. ``seq`` orders them inside a game and is unique there."""
    return union([rows for rows, _ in pitch_branches(spark, sf_dir, limit, width, by_game=False)])


def pitch_branches(
    spark: SparkSession, sf_dir: str, limit: int = HOT_LIMIT, width: int = CHUNK_WIDTH, by_game: bool = True
) -> list[tuple[DataFrame, int | None]]:
    """The pitch rows of ordinary games and, when there are any, of large ones with their chunk width.

    Split at the scan, so that a chain of steps runs once per branch. ``by_game`` deals
    ordinary games out for steps that want all rows of a game in one task.
    """
    hot = hot_games(spark, sf_dir, limit)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    n = lines.count()
    lines = lines.withColumn("g", F.expr(f"cast(floor(l_orderkey / {ORDERS_PER_GAME}) as bigint)"))
    parts = branches(lines, None if hot is None else hot.select("g"), "g", width)
    found = [(_pitches(spark, sf_dir, rows if w else deal(rows, n, "l_orderkey"), w), w) for rows, w in parts]
    return [(deal(rows, n, "game_id") if by_game and w is None else rows, w) for rows, w in found]


def _pitches(spark: SparkSession, sf_dir: str, lines: DataFrame, width: int | None) -> DataFrame:
    order = Order(("l_orderkey",), LINE_ORDER, width, ("l_linenumber", "floor(l_partkey / 100)"))
    numbered = position(lines, "pitch_no", order).select("l_orderkey", "l_quantity", "pitch_no")
    orders = plate_orders(spark, sf_dir)
    # Both sides grow with the input; the planner, which knows the size of the files only, would broadcast the
    # pitches. Dealt out, the orders of a task are few. Repeated orders meet a line as in a broadcast, last one first.
    orders = orders.hint("shuffle_hash" if width is None else "merge")
    return numbered.join(orders, numbered.l_orderkey == orders.o_orderkey).selectExpr(
        f"{GAME_ID} as game_id",
        "inning", "home_or_away", "score_diff",
        "case when b > 2 then 2 else b end as out_count",
        "cast(pitch_no % 4 as int) as ball_count_B",
        "cast(pitch_no % 3 as int) as ball_count_S",
        "cast(o_custkey % 2 as int) as is_base1",
        "cast(floor(o_custkey / 2) % 2 as int) as is_base2",
        "cast(floor(o_custkey / 4) % 2 as int) as is_base3",
        "case when o_custkey % 97 = 5 then null else cast(g * 10 + home_or_away * 4"
        " + case when inning > 6 then 2 else 0 end"
        " + case when o_custkey % 50 = 7 and pitch_no > 2 then 1 else 0 end as bigint) end as pitcher_id",
        "cast(g * 100 + home_or_away * 50 + ((inning - 1) * 4 + b) % 9 as bigint) as batter_id",
        "case o_custkey % 3 when 0 then 'L' when 1 then 'R' else null end as batter_hit_type",
        "case when o_custkey % 23 = 0 then null else cast(o_custkey % 11 as double) / 32 end as pitcher_vs_batter_avg",
        "case when o_custkey % 29 = 0 then null else cast(o_custkey % 13 as double) / 16 end as batter_recent_avg",
        "case when l_quantity % 10 = 0 then null else 110 + l_quantity end as pitch_speed",
        "case when pitch_no % 4 = 3 then null else concat('T', cast(pitch_no % 4 as string)) end as pitch_type",
        "case when l_quantity % 17 = 0 then null else 'H' end as pitch_result",
        "case o_custkey % 14 when 0 then '좌월 홈런' when 1 then '우중간 3루타' when 2 then '좌익수 왼쪽 2루타'"
        " when 3 then '중견수 앞 1루타' when 4 then '고의사구' when 5 then '볼넷' when 6 then '몸에 맞는 공'"
        " when 7 then '헛스윙 삼진 아웃' when 8 then '2루수 병살타 아웃' when 9 then '우익수 희생플라이 아웃'"
        " when 10 then '유격수 땅볼 아웃' when 11 then '중견수 뜬공 아웃' when 12 then '' else '기타' end as relay_text",
        "case when g % 9 = 0 then cast(o_custkey % 41 - 20 as double) end as reward_wpa",
        f"p * {SEQ_STEP} + pitch_no as seq",
    )
