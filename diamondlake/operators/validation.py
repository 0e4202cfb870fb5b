"""Checks of the computed reward, alone and against the provider's figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diamondlake.functions.labels import label_rank
from diamondlake.functions.significance import two_sided_p
from diamondlake.functions.state import season_of
from diamondlake.operators.materialize import materialize
from diamondlake.operators.quantiles import average_ranks, describe, value_counts
from diamondlake.operators.reward import REWARD
from diamondlake.operators.transitions import MANY_RUNS, NONZERO_START

PROVIDER = "reward_wpa"
NORMAL = "normal"

# Acceptance thresholds.
MIN_SIGN_MATCH = 0.80
MIN_SPEARMAN = 0.6
MAX_P = 0.05


def pairs(rewards: DataFrame) -> DataFrame:
    """Rows the provider has a figure for."""
    return rewards.where(F.col(PROVIDER).isNotNull())


def label_means(rewards: DataFrame) -> DataFrame:
    """Count and mean reward per label with the report rank; unknown labels are left out."""
    rank = label_rank(F.col("pa_result"))
    return (
        rewards.where(rank > 0)
        .groupBy("pa_result")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(REWARD).alias("mean_reward"))
        .withColumn("label_rank", rank)
    )


def _self_figures() -> list[Column]:
    def mean_of(label: str) -> Column:
        return F.avg(F.when(F.col("pa_result") == label, F.col(REWARD)))

    return [
        F.count_if(F.col(REWARD).isNull()).alias("missing"),
        F.count_if((F.col(REWARD) < -1) | (F.col(REWARD) > 1)).alias("out_of_range"),
        F.avg(REWARD).alias("grand_mean"),
        mean_of("HR").alias("hr_mean"), mean_of("1B").alias("b1_mean"),
        mean_of("BB").alias("bb_mean"), mean_of("OUT").alias("out_mean"),
    ]


def _with_label_order(one: DataFrame) -> DataFrame:
    falling = (
        (F.col("hr_mean") > F.col("b1_mean")) & (F.col("b1_mean") > F.col("bb_mean"))
        & (F.col("bb_mean") > 0) & (F.col("out_mean") < 0)
    )
    return one.withColumn("domain_ok", F.coalesce(falling, F.lit(False)))


def self_check(rewards: DataFrame) -> DataFrame:
    """Missing, out of range, mean, and whether HR > 1B > BB > 0 > OUT, in one pass."""
    return _with_label_order(rewards.agg(*_self_figures()))


def season_counts(rewards: DataFrame) -> DataFrame:
    return pairs(rewards).groupBy(season_of(F.col("game_id")).alias("season")).agg(F.count("*").alias("n_pa"))


def _sign_figures() -> list[Column]:
    """A pair without the provider's figure is none of equal or unequal sign: its product is NULL."""
    a, b = F.col(PROVIDER), F.col(REWARD)
    signed = (a != 0) & (b != 0)
    return [
        F.count_if(signed).alias("n_signed"),
        F.avg(F.when(signed, (F.signum(a) == F.signum(b)).cast("double"))).alias("sign_match_rate"),
    ]


def sign_match(rewards: DataFrame) -> DataFrame:
    """Share of pairs of equal sign where neither side is 0; NULL without such pairs.

    A condition inside the aggregate, not a filter: a filter on the reward would
    be pushed below its projection and the reward computed twice.
    """
    return pairs(rewards).agg(*_sign_figures())


def _with_t(r: Column, n: Column) -> Column:
    """Test statistic of a correlation; infinite for a perfect one, NULL below three rows."""
    finite = r * F.sqrt((n - 2) / (1 - r * r))
    return F.when(n > 2, F.when(r * r < 1, finite).otherwise(F.signum(r) * float("inf")))


def pearson(rewards: DataFrame) -> DataFrame:
    one = pairs(rewards).agg(F.count("*").alias("n"), F.corr(PROVIDER, REWARD).alias("r"))
    return one.withColumn("t", _with_t(F.col("r"), F.col("n"))).withColumn("p", two_sided_p(F.col("t"), F.col("n") - 2))


def spearman(rewards: DataFrame) -> DataFrame:
    """Rank correlation with mean ranks for ties.

    The pairs are counted once. Both columns are ranked over distinct values and
    the correlation is a weighted sum over distinct pairs, so equal values never
    pile up in a task.
    """
    cells = value_counts(pairs(rewards), [PROVIDER], REWARD)
    n_cells = cells.count()

    def ranks(value: str, out: str) -> DataFrame:
        return average_ranks(cells.groupBy(value).agg(F.sum("n").alias("n")), value, out, at_most=n_cells)

    ranked = (
        cells.where(F.col(REWARD).isNotNull()).withColumnRenamed("n", "w")
        .join(ranks(PROVIDER, "x"), PROVIDER).join(ranks(REWARD, "y"), REWARD)
    )
    w, x, y = F.col("w").cast("double"), F.col("x"), F.col("y")
    sums = ranked.agg(
        F.sum("w").alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
        F.sum(w * x * x).alias("sxx"), F.sum(w * y * y).alias("syy"), F.sum(w * x * y).alias("sxy"),
    )
    n = F.col("n").cast("double")
    top = n * F.col("sxy") - F.col("sx") * F.col("sy")
    under = F.sqrt((n * F.col("sxx") - F.col("sx") ** 2) * (n * F.col("syy") - F.col("sy") ** 2))
    rho = F.try_divide(top, under)
    found = sums.select("n", rho.alias("rho")).withColumn("t", _with_t(F.col("rho"), F.col("n")))
    return found.withColumn("p", two_sided_p(F.col("t"), F.col("n") - 2))


def histogram_2d(rewards: DataFrame, provider_step: float, reward_step: float) -> DataFrame:
    """Counts of the provider/computed plane in cells of the given size."""
    cell = [
        F.floor(F.col(PROVIDER) / provider_step).alias("provider_cell"),
        F.floor(F.col(REWARD) / reward_step).alias("reward_cell"),
    ]
    return pairs(rewards).groupBy(*cell).agg(F.count("*").alias("n"))


MISMATCH_COLUMNS = (
    "game_id", "pa_seq", "inning", "half", "base_state", "score_diff_attacker", "pa_result", "runs_scored", PROVIDER, REWARD,
)


def top_mismatches(rewards: DataFrame, size: int = 10, columns: Sequence[str] = MISMATCH_COLUMNS) -> DataFrame:
    """Pairs of opposite sign with the largest product of absolute values."""
    product = F.col(PROVIDER) * F.col(REWARD)
    ranked = pairs(rewards).select(*columns, F.when(product < 0, -product).alias("abs_product"))
    top = ranked.orderBy(F.desc_nulls_last("abs_product"), "game_id", "pa_seq").limit(size)
    return top.where(F.col("abs_product").isNotNull())


def _flags(spark: SparkSession) -> DataFrame:
    names = F.array(F.lit(NONZERO_START), F.lit(MANY_RUNS), F.lit(NORMAL))
    return spark.range(1).select(F.explode(names).alias("flag"))


def flag_stats(rewards: DataFrame) -> DataFrame:
    """Count, mean and deviation per quality flag; a flag that never occurs has no figures."""
    flag = F.when(F.col("data_quality_flag") == "", NORMAL).otherwise(F.col("data_quality_flag"))
    stats = rewards.groupBy(flag.alias("flag")).agg(
        F.count("*").alias("n"), F.avg(REWARD).alias("mean"), F.stddev_samp(REWARD).alias("std")
    )
    return _flags(rewards.sparkSession).join(stats, "flag", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _long(one_row: DataFrame, columns: list[str]) -> DataFrame:
    """One row of figures -> (metric, value)."""
    doubles = one_row.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([], columns, "metric", "value")


def metrics(rewards: DataFrame) -> DataFrame:
    """The figures the verdict needs as (metric, value) rows. ``rewards`` is read twice."""
    line = [F.count(PROVIDER).alias("n_line"), F.corr(PROVIDER, REWARD).alias("pearson")]
    one = _with_label_order(rewards.agg(*_self_figures(), *_sign_figures(), *line))
    t = _with_t(F.col("pearson"), F.col("n_line"))
    one = one.withColumn("pearson_p", two_sided_p(t, F.col("n_line") - 2))
    rank_part = _long(
        spearman(rewards).withColumnsRenamed({"n": "n_pairs", "rho": "spearman", "t": "spearman_t", "p": "spearman_p"}),
        ["n_pairs", "spearman", "spearman_t", "spearman_p"],
    )
    names = ["missing", "out_of_range", "grand_mean", "hr_mean", "b1_mean", "bb_mean", "out_mean", "domain_ok", "sign_match_rate", "pearson", "pearson_p"]
    return _long(one, names).unionByName(rank_part)


def _metric(name: str) -> Column:
    return F.max(F.when(F.col("metric") == name, F.col("value")))


def verdict(metric_rows: DataFrame) -> DataFrame:
    """Five criteria with value, threshold and PASS/FAIL, and the overall conclusion."""
    named = ["missing", "out_of_range", "sign_match_rate", "spearman", "spearman_p", "domain_ok"]
    one = metric_rows.agg(*[_metric(name).alias(name) for name in named])
    criteria = [
        (1, "missing", "= 0", F.col("missing"), F.col("missing") == 0),
        (2, "out_of_range", "= 0", F.col("out_of_range"), F.col("out_of_range") == 0),
        (3, "sign_match_rate", ">= 0.80", F.col("sign_match_rate"), F.col("sign_match_rate") >= MIN_SIGN_MATCH),
        (4, "spearman", ">= 0.6, p < 0.05", F.col("spearman"),
         (F.col("spearman") >= MIN_SPEARMAN) & (F.col("spearman_p") < MAX_P)),
        (5, "label_order", "HR>1B>BB>0>OUT", F.col("domain_ok"), F.col("domain_ok") == 1),
    ]
    passed = [F.coalesce(ok, F.lit(False)).cast("int") for *_, ok in criteria]
    n_pass = sum(passed[1:], passed[0])
    low = (F.col("sign_match_rate") < 0.5) | (
        (F.col("sign_match_rate") < MIN_SIGN_MATCH) & (F.col("spearman") < MIN_SPEARMAN)
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias("number"), F.lit(name).alias("criterion"), F.lit(threshold).alias("threshold"),
                value.alias("value"), F.when(ok == 1, "PASS").otherwise("FAIL").alias("result"),
            )
            for (number, name, threshold, value, _), ok in zip(criteria, passed)
        ]
    )
    conclusion = F.when(n_pass == len(criteria), "complete").when(low, "sign error suspected").otherwise("refine")
    exploded = one.select(F.explode(rows).alias("row"), n_pass.alias("n_pass"), conclusion.alias("conclusion"))
    return exploded.select("row.*", "n_pass", "conclusion")


def report(rewards: DataFrame) -> DataFrame:
    """All tables of the validation as (section, item, value)."""
    rewards = materialize(
        rewards.select("game_id", "pa_seq", "pa_result", "data_quality_flag", PROVIDER, REWARD)
    )
    figures = materialize(metrics(rewards))

    def part(df: DataFrame, section: str, item: Column, value: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), item.cast("string").alias("item"), value.cast("double").alias("value"))

    judged = materialize(verdict(figures))
    mismatch = top_mismatches(rewards, columns=("game_id", "pa_seq"))
    labels, flags = label_means(rewards), flag_stats(rewards)
    shape = ["n", "mean", "std", "min", "q25", "q50", "q75", "max"]
    parts = [
        part(figures, "figures", F.col("metric"), F.col("value")),
        part(labels, "label_mean", F.col("pa_result"), F.col("mean_reward")),
        part(labels, "label_n", F.col("pa_result"), F.col("n")),
        part(season_counts(rewards), "season", F.col("season"), F.col("n_pa")),
        part(_long(describe(pairs(rewards), [], PROVIDER), shape), "provider", F.col("metric"), F.col("value")),
        part(flags, "flag_n", F.col("flag"), F.col("n")),
        part(flags, "flag_mean", F.col("flag"), F.col("mean")),
        part(flags, "flag_std", F.col("flag"), F.col("std")),
        part(mismatch, "mismatch", F.concat_ws("#", "game_id", "pa_seq"), F.col("abs_product")),
        part(judged, "criterion", F.concat_ws(" ", "criterion", "threshold"), F.col("value")),
        part(judged, "passed", F.col("criterion"), (F.col("result") == "PASS").cast("int")),
        part(judged.limit(1), "conclusion", F.col("conclusion"), F.col("n_pass")),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
