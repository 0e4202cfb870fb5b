"""Distribution tables over plate appearances.

Tables over few values start from one grouped pass: counts per combination of
the small dimensions, from which every single table is folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.functions.state import clip_score
from diamondlake.operators.columns import percent_of_total, ratio
from diamondlake.operators.quantiles import describe
from diamondlake.operators.reward import REWARD

NUMERIC = [
    "we_before", "we_after", "pitcher_vs_batter_avg", "batter_recent_avg",
    "pa_avg_pitch_speed", "total_pitch_count", "inning_pitch_count",
]
SITUATIONS = ["out_count", "base_state", "half", "inning", "batter_hit_type"]
CROSSED = ["out_count", "base_state", "batter_hit_type"]


def clean(rewards: DataFrame) -> DataFrame:
    return rewards.where(F.col("data_quality_flag") == "")


def _share(counted: DataFrame, within: list[str], out: str) -> DataFrame:
    """Percent of n within a group of the already counted rows (a few hundred at most)."""
    total = F.sum("n").over(Window.partitionBy(*within))
    return counted.withColumn(out, ratio(F.col("n"), total) * 100)


def value_counts(df: DataFrame, value: str) -> DataFrame:
    return percent_of_total(df.groupBy(value).agg(F.count("*").alias("n")), "pct")


def unknown_rate(pa: DataFrame) -> DataFrame:
    unknown = F.col("pa_result") == "UNK"
    one = pa.agg(F.count("*").alias("n_pa"), F.count_if(unknown).alias("n_unknown"))
    rate = ratio(F.col("n_unknown"), F.col("n_pa"))
    return one.withColumn("unknown_rate", rate).withColumn("alarm", rate > 0.05)


def mean_by_label(df: DataFrame, value: str, out: str) -> DataFrame:
    return df.groupBy("pa_result").agg(F.count(value).alias("n"), F.avg(F.col(value).cast("double")).alias(out))


def situation_distribution(df: DataFrame) -> DataFrame:
    """Counts and percent of outs, bases, half, inning and batting side."""
    cells = df.groupBy(*SITUATIONS).agg(F.count("*").alias("cell"))
    texts = cells.select("cell", *[F.col(c).cast("string").alias(c) for c in SITUATIONS])
    long = texts.unpivot(["cell"], SITUATIONS, "dimension", "value").where(F.col("value").isNotNull())
    counted = long.groupBy("dimension", "value").agg(F.sum("cell").alias("n"))
    return _share(counted, ["dimension"], "pct")


def label_crosstab(df: DataFrame) -> DataFrame:
    """Label against outs, bases and batting side, with row percent."""
    cells = df.groupBy("pa_result", *CROSSED).agg(F.count("*").alias("cell"))
    texts = cells.select("pa_result", "cell", *[F.col(c).cast("string").alias(c) for c in CROSSED])
    long = texts.unpivot(["pa_result", "cell"], CROSSED, "dimension", "value").where(F.col("value").isNotNull())
    counted = long.groupBy("pa_result", "dimension", "value").agg(F.sum("cell").alias("n"))
    return _share(counted, ["pa_result", "dimension"], "row_pct")


def label_out_pivot(df: DataFrame) -> DataFrame:
    """Label rows, one percent column per out count."""
    wide = df.groupBy("pa_result").pivot("out_count", [0, 1, 2]).agg(F.count(F.lit(1)))
    counts = [F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in range(3)]
    total = counts[0] + counts[1] + counts[2]
    return wide.select("pa_result", *[(ratio(c, total) * 100).alias(f"pct_out{n}") for n, c in enumerate(counts)])


def clipped_scores(df: DataFrame) -> DataFrame:
    """Score seen from the batting team, clipped to the table range."""
    clipped = df.withColumn("score_clipped", clip_score(F.col("score_diff_attacker")))
    return value_counts(clipped, "score_clipped")


def score_summary(df: DataFrame) -> DataFrame:
    score = F.col("score_diff_attacker")
    one = df.agg(
        F.count("*").alias("n"), F.min(score).alias("min"), F.max(score).alias("max"),
        F.avg(score.cast("double")).alias("mean"), F.stddev_samp(score.cast("double")).alias("std"),
        F.count_if(F.abs(score) >= 4).alias("n_abs4"),
    )
    return one.withColumn("pct_abs4", ratio(F.col("n_abs4"), F.col("n")) * 100)


def numeric_profile(df: DataFrame) -> DataFrame:
    """Missing count, moments and quartiles of the numeric columns."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in NUMERIC])
    return describe(doubles.unpivot([], NUMERIC, "metric", "value"), ["metric"], "value")


def inning_end_rate(df: DataFrame) -> DataFrame:
    """Share of plate appearances that end a half, per label and over all (label 'ALL')."""
    ended = F.col("inning_ended").cast("int")
    label = df.groupBy("pa_result").agg(F.count("*").alias("n"), F.sum(ended).cast("bigint").alias("n_ended"))
    every = label.agg(F.lit("ALL").alias("pa_result"), F.sum("n").alias("n"), F.sum("n_ended").alias("n_ended"))
    both = label.unionByName(every)
    return both.withColumn("pct_ended", ratio(F.col("n_ended"), F.col("n")) * 100)


def quality_summary(rewards: DataFrame) -> DataFrame:
    """Rows, clean and flagged share, missing values, unknown labels, distinct ids."""
    is_clean = F.col("data_quality_flag") == ""

    def missing(name: str) -> Column:
        return F.count_if(is_clean & F.col(name).isNull()).alias(f"{name}_missing")

    one = rewards.agg(
        F.count("*").alias("n_rows"), F.count_if(is_clean).alias("n_clean"), F.count_if(~is_clean).alias("n_flagged"),
        *[missing(c) for c in (REWARD, "we_before", "we_after", "pitcher_vs_batter_avg", "batter_recent_avg", "pa_avg_pitch_speed")],
        F.count_if(is_clean & (F.col("pa_result") == "UNK")).alias("n_unknown"),
        F.countDistinct(F.when(is_clean, F.col("game_id"))).alias("n_games"),
        F.countDistinct(F.when(is_clean, F.col("pitcher_id"))).alias("n_pitchers"),
        F.countDistinct(F.when(is_clean, F.col("batter_id"))).alias("n_batters"),
    )
    return one.withColumns(
        {
            "pct_clean": ratio(F.col("n_clean"), F.col("n_rows")) * 100,
            "pct_unknown": ratio(F.col("n_unknown"), F.col("n_clean")) * 100,
        }
    )


def mean_variance_utility(df: DataFrame, risk: float, keys: tuple[str, ...] = ("half", "base_state", "out_count")) -> DataFrame:
    """Mean reward minus ``risk`` times its variance, per state."""
    stats = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(REWARD).alias("mean_reward"), F.var_samp(REWARD).alias("var_reward")
    )
    return stats.withColumn("utility", F.col("mean_reward") - risk * F.col("var_reward"))
