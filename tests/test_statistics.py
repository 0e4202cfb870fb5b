"""Ranks, quantiles, verdicts and profiles on small frames against plain Python."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from diamondlake.operators import conventions, features, profile, validation
from diamondlake.operators.quantiles import average_ranks, describe, value_counts, value_ranks

VALUES = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, -0.001, 0.001, 5.0])), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(VALUES)
def test_describe(spark, values):
    frame = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "k int, v double")
    got = {r.k: r for r in describe(frame, ["k"], "v").collect()}
    for k, part in pd.DataFrame({"k": [i % 2 for i in range(len(values))], "v": pd.Series(values, dtype=float)}).groupby("k"):
        want, row = part.v.describe(), got[k]
        assert row.n == want["count"] and row.missing == part.v.isna().sum()
        for name, key in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            have = np.nan if row[name] is None else row[name]
            np.testing.assert_allclose(have, want[key], rtol=1e-9, atol=1e-9)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-100, 100), min_size=1, max_size=50))
def test_average_ranks(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.r for r in average_ranks(value_counts(frame, [], "v"), "v", "r").collect()}
    want = pd.Series(values).rank(method="average")
    assert all(got[v] == w for v, w in zip(values, want))


@pytest.mark.parametrize("draw", [lambda rng: 1 + rng.random(20_000) * 1e-9, lambda rng: np.exp(rng.normal(0, 8, 20_000)), lambda rng: np.floor(rng.pareto(0.5, 20_000))])
def test_ranges_of_skewed_values(spark, monkeypatch, draw):
    """However the values are spread, a range of the sample sort holds about the rows asked for."""
    written = []

    def keep(df):
        written.append(df.cache())
        return written[-1]

    values = draw(np.random.default_rng(3))
    counts = spark.createDataFrame(pd.DataFrame({"v": values})).groupBy("v").count().withColumnRenamed("count", "n")
    monkeypatch.setattr("diamondlake.operators.quantiles.materialize", keep)
    got = value_ranks(counts, "v", range_rows=1_000).toPandas().set_index("v").upto
    want = pd.Series(values).rank(method="max")
    assert (got.reindex(values).to_numpy() == want.to_numpy()).all()
    sizes = [r["count"] for r in written[0].groupBy("__range").count().collect()]
    assert max(sizes) <= 2_000 and len(sizes) >= len(got) // 2_000


def test_ranks_of_nothing(spark):
    assert average_ranks(spark.createDataFrame([(None, 3)], "v double, n long"), "v", "r").isEmpty()
    assert average_ranks(spark.createDataFrame([], "v double, n long"), "v", "r").isEmpty()


REWARDS = "game_id string, pa_seq long, inning int, half string, base_state string, score_diff_attacker int, pa_result string, runs_scored int, reward_wpa double, reward_wpa_computed double, data_quality_flag string"


def rewards(spark, rows):
    return spark.createDataFrame([("20240001HHSK02024", i, 1, "top", "0", 0, label, 0, a, b, flag) for i, (label, a, b, flag) in enumerate(rows)], REWARDS)


def test_spearman_pearson_sign(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(-5, 6, 300).astype(float)
    b = np.round(a / 50 + rng.normal(0, 0.05, 300), 2)
    frame = rewards(spark, [("OUT", float(x), float(y), "") for x, y in zip(a, b)] + [("OUT", None, 0.9, "")])
    pair = pd.DataFrame({"a": a, "b": b})
    got = validation.spearman(frame).first()
    assert got.n == 300 and got.rho == pytest.approx(pair.rank().corr().iloc[0, 1], abs=1e-12)
    assert validation.pearson(frame).first().r == pytest.approx(pair.corr().iloc[0, 1], abs=1e-12)
    both = pair[(pair.a != 0) & (pair.b != 0)]
    row = validation.sign_match(frame).first()
    assert row.n_signed == len(both) and row.sign_match_rate == pytest.approx((np.sign(both.a) == np.sign(both.b)).mean())


def test_no_pairs(spark):
    frame = rewards(spark, [("OUT", None, 0.1, ""), ("OUT", 0.0, 0.1, "")])
    assert validation.sign_match(frame).first().sign_match_rate is None
    assert validation.top_mismatches(frame).isEmpty()


def test_verdict_pass_and_fail(spark):
    good = [("HR", 9.0 + i, 0.3 + i / 1000, "") for i in range(9)] + [("1B", 5.0 + i / 10, 0.2 + i / 1000, "") for i in range(9)]
    good += [("BB", 3.0 + i / 10, 0.1 + i / 1000, "") for i in range(9)] + [("OUT", -3.0 - i, -0.1 - i / 1000, "") for i in range(9)]
    rows = validation.verdict(validation.metrics(rewards(spark, good))).orderBy("number").collect()
    assert [r.result for r in rows] == ["PASS"] * 5 and {r.conclusion for r in rows} == {"complete"} and rows[0].n_pass == 5
    flipped = [(label, a, -b, flag) for label, a, b, flag in good]
    rows = validation.verdict(validation.metrics(rewards(spark, flipped))).orderBy("number").collect()
    assert [r.result for r in rows] == ["PASS", "PASS", "FAIL", "FAIL", "FAIL"] and rows[0].conclusion == "sign error suspected"
    odd = good + [("OUT", None, 1.5, ""), ("OUT", None, None, "")]
    rows = validation.verdict(validation.metrics(rewards(spark, odd))).orderBy("number").collect()
    assert [r.result for r in rows[:4]] == ["FAIL", "FAIL", "PASS", "PASS"] and rows[0].conclusion == "refine"


def test_domain_order_needs_every_label(spark):
    assert not validation.self_check(rewards(spark, [("HR", None, 0.4, ""), ("OUT", None, -0.1, "")])).first().domain_ok


def test_label_means_and_flags(spark):
    frame = rewards(spark, [("HR", None, 0.4, ""), ("ODD", None, 0.1, "high_runs_scored_artifact"), ("HR", None, 0.2, "")])
    assert [(r.pa_result, r.n, r.mean_reward, r.label_rank) for r in validation.label_means(frame).collect()] == [("HR", 2, pytest.approx(0.3), 1)]
    flags = {r.flag: (r.n, r.mean, r.std) for r in validation.flag_stats(frame).collect()}
    assert flags["inning1_nonzero_start"] == (0, None, None) and flags["high_runs_scored_artifact"] == (1, 0.1, None)
    assert flags["normal"] == (2, pytest.approx(0.3), pytest.approx(0.1414213562))


PA = "game_id string, pa_seq long, inning int, home_or_away int, score_diff int, out_count int, is_base1 int, is_base2 int, is_base3 int, pa_result string"


def games(spark, scores):
    """scores: (game, inning, code) -> scores in order"""
    rows, at = [], 0
    for (game, inning, code), values in scores.items():
        for v in values:
            at += 1
            rows.append((game, at, inning, code, v, 0, 0, 0, 0, "OUT"))
    return spark.createDataFrame(rows, PA)


@pytest.mark.parametrize(
    ("top", "bottom", "winner", "counts"),
    [
        ([0, -1, -1], [-1, 0, 2], "H1", (0, 1, 2, 1)),
        ([0, 1, 1], [-1, 0, 2], "H2", (1, 0, 1, 2)),
        ([0, 1, 1], [2, 0, 0], "H3", (2, 1, 0, 1)),
        ([0, -1], [2, 0], "H4", (1, 2, 1, 0)),
        ([0, 0], [0], "H4", (0, 0, 0, 0)),
        ([0, 1, 0], [0, 1, 0], "UNKNOWN", (2, 2, 2, 2)),
    ],
)
def test_hypotheses(spark, top, bottom, winner, counts):
    moves = conventions.half_moves(games(spark, {("a", 1, 0): top, ("a", 1, 1): bottom}))
    row = conventions.hypotheses(moves).first()
    assert ((row.h1, row.h2, row.h3, row.h4), row.winner, row.n_halves) == (counts, winner, 2)


def test_half_order_and_widest(spark):
    frame = games(spark, {("b", 1, 0): [0, 4], ("b", 1, 1): [4], ("a", 1, 1): [1], ("a", 1, 0): [5], ("a", 2, 0): [1]})
    row = conventions.half_order_check(frame).first()
    assert (row.n_both, row.order_ok, row.order_fail) == (2, 1, 1)
    assert tuple(conventions.widest_game(frame).first()) == ("a", 4)


@pytest.mark.parametrize("n", [3, 60, 61, 100])
def test_head_and_tail(spark, n):
    frame = games(spark, {("a", 1, 0): list(range(n))})
    kept = sorted(r.pa_seq for r in conventions.game_head_tail(frame).collect())
    assert kept == (list(range(1, n + 1)) if n <= 60 else [*range(1, 31), *range(n - 29, n + 1)])


def test_training_set_options(spark, small):
    from diamondlake.plans.queries import rewards as full

    frame = full(spark, small).cache()
    clean = profile.clean(frame)
    filled = features.training_set(frame)
    assert filled.count() == clean.count() and filled.where("pitcher_vs_batter_avg is null").isEmpty()
    bare = features.training_set(frame, average_fill=None, regular_only=True, with_speed=True)
    assert bare.where("inning > 9").isEmpty() and not bare.where("pitcher_vs_batter_avg is null").isEmpty()
    assert bare.where("speed_missing and pa_avg_pitch_speed <> 131.0").isEmpty()
    with pytest.raises(ValueError):
        features.training_set(frame.drop("half"))
