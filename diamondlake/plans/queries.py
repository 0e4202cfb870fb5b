"""Registered queries: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from diamondlake.functions import expectancy, labels, parsing, state
from diamondlake.operators import conventions, features, profile, transitions, validation
from diamondlake.operators.columns import order_columns
from diamondlake.operators.materialize import materialize, shared_folder
from diamondlake.operators.ordered import Order, position, union
from diamondlake.operators.plate_appearances import add_pitch_counts, add_recent_speed, aggregate_pa, assign_pa
from diamondlake.operators.quantiles import describe
from diamondlake.operators.reward import REWARD, add_reward
from diamondlake.plans import pitch_view as view
from diamondlake.plans import relay_view
from diamondlake.schemas import PITCH, PITCH_COLUMNS
from diamondlake.sources import layers, relay, schedule

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 6


def query(function: Query) -> Query:
    """Register under the function's name; doubles are rounded for comparison."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, DIGITS) for name in doubles}) if doubles else df


# ---- frames the queries share ------------------------------------------------


def pitches(spark: SparkSession, d: str) -> DataFrame:
    return view.pitch_view(spark, d)


def by_game_size(spark: SparkSession, d: str, run: Callable[[DataFrame, int | None], DataFrame]) -> DataFrame:
    """A whole chain over the pitch rows, run apart for games too large for one task."""
    return union([run(rows, width) for rows, width in view.pitch_branches(spark, d)])


def _plate(rows: DataFrame, width: int | None) -> DataFrame:
    return aggregate_pa(add_pitch_counts(assign_pa(rows, width), width=width))


def plate(spark: SparkSession, d: str) -> DataFrame:
    return by_game_size(spark, d, _plate)


def linked(spark: SparkSession, d: str) -> DataFrame:
    return by_game_size(spark, d, lambda rows, w: transitions.link_transitions(_plate(rows, w), width=w))


def states(spark: SparkSession, d: str) -> DataFrame:
    return by_game_size(spark, d, lambda rows, w: transitions.transitions(_plate(rows, w), width=w))


def rewards(spark: SparkSession, d: str) -> DataFrame:
    return add_reward(states(spark, d))


def clean(spark: SparkSession, d: str) -> DataFrame:
    return profile.clean(rewards(spark, d))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return relay_view.relay_documents(spark, d)


# ---- sources -------------------------------------------------------------------


@query
def relay_scan(spark, d):
    return documents(spark, d).groupBy("game_id").agg(
        F.count("*").alias("n_documents"), F.min("req_inning").alias("first_inning"), F.max("req_inning").alias("last_inning")
    )


@query
def inning_cutoff(spark, d):
    return relay.kept_innings(documents(spark, d))


@query
def relay_explode(spark, d):
    kind = F.col("kind")
    return relay.options(documents(spark, d)).groupBy("game_id", "req_inning").agg(
        F.count("*").alias("n_options"), F.count_if(kind == relay.BATTER_EVENT).alias("n_batter"),
        F.count_if(kind == relay.PITCH_EVENT).alias("n_pitch"), F.count_if(kind.isin(*relay.RESULT_EVENTS)).alias("n_result"),
        F.max("relay_pos").alias("last_relay"), F.max("opt_pos").alias("last_option"),
    )


@query
def pitch_rows(spark, d):
    return relay.pitch_rows(documents(spark, d)).drop("seq")


@query
def pitch_seq(spark, d):
    rows = relay.pitch_rows(documents(spark, d))
    return position(rows, "place", Order(("game_id",), ("seq",))).select("game_id", "place", "batter_text", "ball_count_B", "home_or_away")


@query
def pitch_rejects(spark, d):
    rejects = relay.rejects_of(relay.cut_after_end(relay.raw_pitches(documents(spark, d))))
    return rejects.groupBy("game_id", "reason").agg(F.count("*").alias("n_rejected"))


@query
def pitch_table(spark, d):
    return relay.parse_pitches(documents(spark, d)).drop("seq")


@query
def safe_casts(spark, d):
    columns = ["score_diff", "pitch_speed", "is_base1", "is_base2", "is_base3", "pitcher_vs_batter_avg", "batter_recent_avg"]
    return relay.pitch_rows(documents(spark, d)).groupBy(*columns).agg(F.count("*").alias("n"))


@query
def hit_type(spark, d):
    words = F.expr(
        "case o_custkey % 7 when 0 then '우투좌타' when 1 then '좌투좌타' when 2 then '우투우타'"
        " when 3 then '좌투우타' when 4 then '우투양타' when 5 then '' else null end"
    )
    handed = view.table(spark, d, "orders").select(words.alias("handedness"))
    return handed.groupBy("handedness", parsing.hit_side(F.col("handedness")).alias("side")).agg(F.count("*").alias("n"))


@query
def schedule_ids(spark, d):
    return schedule.target_game_ids(relay_view.schedule_documents(spark, d))


@query
def id_list(spark, d):
    ids = schedule.clean_id_lines(relay_view.id_lines(spark, d))
    return ids.groupBy("game_id").agg(F.count("*").alias("n_lines"))


@query
def month_windows(spark, d):
    """The months to ask for that hold orders, over the years of the orders."""
    dates = view.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    years = dates.agg(F.min(F.year("day")), F.max(F.year("day"))).first()
    counted = dates.groupBy(F.trunc("day", "month").alias("first_day")).agg(F.count("*").alias("n_orders"))
    windows = schedule.month_windows(spark, *years)
    return windows.join(counted, "first_day").select("first_day", "last_day", "n_orders")


@query
def csv_roundtrip(spark, d):
    counted = by_game_size(spark, d, lambda rows, w: add_recent_speed(add_pitch_counts(rows, width=w), width=w))
    return layers.csv_round_trip(counted.select(*PITCH.names), f"{shared_folder(spark)}/csv/{uuid.uuid4().hex}")


@query
def pitch_order_cols(spark, d):
    shuffled = pitches(spark, d).select("seq", "reward_wpa", "pitch_speed", "inning", "game_id")
    return order_columns(shuffled, PITCH_COLUMNS)


@query
def game_id_parts(spark, d):
    games = relay_view.relay_orders(spark, d).select("game_id").distinct()
    return games.select("game_id", *state.game_id_parts(F.col("game_id")))


def _per_game(rows: DataFrame) -> DataFrame:
    return rows.groupBy("game_id").agg(F.count("*").alias("n_pitches"))


@query
def listed_semi(spark, d):
    return _per_game(schedule.only_listed(pitches(spark, d), schedule_ids(spark, d)))


@query
def resume_anti(spark, d):
    done = relay_view.relay_orders(spark, d).where("g % 2 = 0").select("game_id").distinct()
    return _per_game(schedule.not_done(pitches(spark, d), done))


# ---- pitches and plate appearances ---------------------------------------------


@query
def pa_seq(spark, d):
    return by_game_size(spark, d, assign_pa).select("game_id", "seq", "pa_seq")


@query
def pitch_counts(spark, d):
    counted = by_game_size(spark, d, lambda rows, w: add_pitch_counts(rows, width=w))
    return counted.select("game_id", "seq", "total_pitch_count", "inning_pitch_count")


@query
def recent_speed_avg(spark, d):
    meaned = by_game_size(spark, d, lambda rows, w: add_recent_speed(rows, width=w))
    return meaned.select("game_id", "seq", "recent_5_pitch_speed_avg")


@query
def classify_result(spark, d):
    labelled = pitches(spark, d).groupBy("relay_text").agg(F.count("*").alias("n"))
    return labelled.withColumn("pa_result", labels.classify_result(F.col("relay_text")))


@query
def runs_from_text(spark, d):
    words = F.expr(
        "case o_custkey % 11 when 0 then '만루  홈런' when 1 then '만루홈런' when 2 then '좌월 3점 홈런' when 3 then '쓰리런'"
        " when 4 then '2점홈런' when 5 then '투런' when 6 then '우월 홈런' when 7 then concat(cast(o_custkey % 13 as string), '점 적시타')"
        " when 8 then '  ' when 9 then null else '땅볼' end"
    )
    texts = view.table(spark, d, "orders").select(words.alias("relay_text"))
    counted = texts.groupBy("relay_text").agg(F.count("*").alias("n"))
    return counted.withColumn("runs", labels.runs_from_text(F.col("relay_text")))


@query
def pa_aggregate(spark, d):
    return plate(spark, d)


# ---- states, expectancy, reward -------------------------------------------------


@query
def pa_states(spark, d):
    before = transitions.add_before_state(plate(spark, d))
    return before.select("game_id", "pa_seq", "base_state", "half", "score_diff_attacker", "we_before")


@query
def re_lookup(spark, d):
    before = transitions.add_before_state(plate(spark, d))
    # Outs shifted by 0..2, so that the three-out rule is met as well.
    outs = F.col("out_count") + F.col("inning") % 3
    return before.select("game_id", "pa_seq", outs.alias("outs"), expectancy.run_expectancy(outs, F.col("base_state")).alias("re"))


def _we_inputs(spark: SparkSession, d: str) -> DataFrame:
    return transitions.add_before_state(plate(spark, d)).withColumn("outs", F.col("out_count") + F.col("pa_seq") % 3)


@query
def we_lookup(spark, d):
    we = expectancy.win_expectancy(F.col("inning"), F.col("half"), F.col("score_diff_attacker"), F.col("base_state"))
    return _we_inputs(spark, d).select("game_id", "pa_seq", we.alias("we"))


@query
def we_boundary(spark, d):
    columns = [F.col(c) for c in ("inning", "half", "score_diff_attacker", "outs", "base_state")]
    return _we_inputs(spark, d).select("game_id", "pa_seq", expectancy.win_expectancy_with_end(*columns).alias("we"))


@query
def we_out_adjusted(spark, d):
    columns = [F.col(c) for c in ("inning", "half", "score_diff_attacker", "out_count", "base_state")]
    return _we_inputs(spark, d).select("game_id", "pa_seq", expectancy.win_expectancy_out_adjusted(*columns, 0.25).alias("we"))


@query
def pa_next_state(spark, d):
    inside = ~F.col("inning_ended")
    columns = [F.when(inside, F.col(c)).alias(c) for c in ("next_score", "next_outs", "next_base")]
    return linked(spark, d).select("game_id", "pa_seq", *columns)


@query
def inning_ended(spark, d):
    return states(spark, d).select("game_id", "pa_seq", "inning_ended")


@query
def runs_scored(spark, d):
    return linked(spark, d).select("game_id", "pa_seq", "runs_scored", "runs_guessed")


@query
def we_after(spark, d):
    return states(spark, d).select("game_id", "pa_seq", "we_after")


@query
def quality_flag(spark, d):
    return states(spark, d).select("game_id", "pa_seq", "data_quality_flag")


@query
def runs_fallback_rate(spark, d):
    return transitions.fallback_rate(linked(spark, d))


@query
def state_checks(spark, d):
    return transitions.state_checks(states(spark, d))


@query
def half_inning_check(spark, d):
    return conventions.half_inning_check(states(spark, d))


@query
def pa_wpa(spark, d):
    return rewards(spark, d)


# ---- validation -------------------------------------------------------------------


@query
def wpa_by_result(spark, d):
    return validation.label_means(rewards(spark, d))


@query
def wpa_self_check(spark, d):
    return validation.self_check(rewards(spark, d))


@query
def season_counts(spark, d):
    return validation.season_counts(rewards(spark, d))


@query
def wpa_describe(spark, d):
    return describe(clean(spark, d).select(REWARD), [], REWARD)


@query
def provider_describe(spark, d):
    return describe(validation.pairs(rewards(spark, d)).select("reward_wpa"), [], "reward_wpa")


@query
def sign_match(spark, d):
    return validation.sign_match(rewards(spark, d))


@query
def wpa_pearson(spark, d):
    return validation.pearson(rewards(spark, d))


@query
def wpa_spearman(spark, d):
    return validation.spearman(rewards(spark, d))


@query
def flag_stats(spark, d):
    return validation.flag_stats(rewards(spark, d))


@query
def top_mismatch(spark, d):
    return validation.top_mismatches(rewards(spark, d))


@query
def wpa_hist2d(spark, d):
    return validation.histogram_2d(rewards(spark, d), 5.0, 0.05)


@query
def wpa_verdict(spark, d):
    narrow = rewards(spark, d).select("pa_result", "reward_wpa", REWARD)
    return validation.verdict(validation.metrics(materialize(narrow)))  # read four times


@query
def wpa_report(spark, d):
    return validation.report(rewards(spark, d))


# ---- score convention ---------------------------------------------------------------


def _moves(spark: SparkSession, d: str) -> DataFrame:
    return by_game_size(spark, d, lambda rows, w: conventions.half_moves(_plate(rows, w), w))


def _plate_of_games(spark: SparkSession, d: str, games: DataFrame) -> DataFrame:
    """Plate appearances of a few games, a frame of a stated number of rows."""
    few = F.broadcast(games)
    branches = view.pitch_branches(spark, d, by_game=False)
    return union([_plate(rows.join(few, "game_id", "left_semi"), w) for rows, w in branches])


@query
def widest_game(spark, d):
    return conventions.widest_game(plate(spark, d))


@query
def game_head_tail(spark, d):
    """The widest game is found from the scores; only its own rows go through the whole chain."""
    game = materialize(conventions.widest_game(plate(spark, d)).select("game_id"))  # one row
    return conventions.head_tail(materialize(_plate_of_games(spark, d, game)))  # read twice


@query
def convention_hypotheses(spark, d):
    return conventions.hypotheses(_moves(spark, d))


@query
def violation_sample(spark, d):
    """The halves are found first; only their games go through the chain again."""
    first = materialize(conventions.first_violations(_moves(spark, d)))  # three rows at most
    return conventions.rows_of_halves(_plate_of_games(spark, d, first.select("game_id").distinct()), first)


@query
def convention_first_inning(spark, d):
    return conventions.opening_scores(plate(spark, d))


@query
def opening_nonzero(spark, d):
    return conventions.nonzero_openings(plate(spark, d))


@query
def half_code_share(spark, d):
    return conventions.half_code_share(plate(spark, d))


@query
def half_order_check(spark, d):
    return conventions.half_order_check(plate(spark, d))


# ---- distributions and features -------------------------------------------------------


@query
def pa_result_dist(spark, d):
    return profile.value_counts(clean(spark, d), "pa_result")


@query
def pa_result_counts(spark, d):
    return profile.value_counts(rewards(spark, d), "pa_result")


@query
def pitches_per_pa_all(spark, d):
    return describe(rewards(spark, d).select("pitches_per_pa"), [], "pitches_per_pa")


@query
def unk_rate(spark, d):
    return profile.unknown_rate(plate(spark, d))


@query
def pitches_per_pa(spark, d):
    return describe(clean(spark, d).select("pitches_per_pa"), [], "pitches_per_pa")


@query
def pitch_count_hist(spark, d):
    return profile.value_counts(clean(spark, d), "pitches_per_pa")


@query
def pitches_by_result(spark, d):
    return profile.mean_by_label(clean(spark, d), "pitches_per_pa", "mean_pitches")


@query
def wpa_by_result_full(spark, d):
    return describe(clean(spark, d).select("pa_result", REWARD), ["pa_result"], REWARD)


@query
def runs_dist(spark, d):
    return profile.value_counts(clean(spark, d), "runs_scored")


@query
def runs_by_result(spark, d):
    return profile.mean_by_label(clean(spark, d), "runs_scored", "mean_runs")


@query
def situation_dist(spark, d):
    return profile.situation_distribution(clean(spark, d))


@query
def label_crosstab(spark, d):
    return profile.label_crosstab(clean(spark, d))


@query
def label_out_pivot(spark, d):
    return profile.label_out_pivot(clean(spark, d))


@query
def score_clip_dist(spark, d):
    return profile.clipped_scores(clean(spark, d))


@query
def score_summary(spark, d):
    return profile.score_summary(clean(spark, d))


@query
def numeric_profile(spark, d):
    return profile.numeric_profile(clean(spark, d))


@query
def inning_end_rate(spark, d):
    return profile.inning_end_rate(clean(spark, d))


@query
def quality_summary(spark, d):
    return profile.quality_summary(rewards(spark, d))


@query
def mean_var_utility(spark, d):
    return profile.mean_variance_utility(clean(spark, d), 0.5)


@query
def training_set(spark, d):
    return features.training_set(rewards(spark, d))


@query
def training_set_regular(spark, d):
    return features.training_set(rewards(spark, d), average_fill=None, regular_only=True, with_speed=True)
