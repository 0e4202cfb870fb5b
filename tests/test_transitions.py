"""Hand-written games: rewards published for real ones, scores, gaps, flags."""

import pytest
from pyspark.sql import functions as F

from diamondlake.operators.reward import add_reward, check_reward
from diamondlake.operators.transitions import fallback_rate, link_transitions, transitions

SCHEMA = (
    "game_id string, pa_seq long, inning int, home_or_away int, score_diff int, out_count int,"
    " is_base1 int, is_base2 int, is_base3 int, pa_result string, reward_wpa double"
)
ATTACK = {"top": 0, "bot": 1}


def pa(spark, rows):
    return spark.createDataFrame([(*row, None) for row in rows], SCHEMA)


def bases(text):
    return [int(str(n) in text) for n in (1, 2, 3)]


# inning, half, base, score of the batting team, runs, next base (None: last of the half), reward
PUBLISHED = [
    (2, "bot", "12", -2, 0, "23", 0.059),
    (6, "bot", "12", -1, 0, "23", 0.11425),
    (7, "bot", "2", -1, 0, "12", 0.049),
    (2, "bot", "12", 0, 0, "3", 0.031),
    (10, "top", "1", 0, 0, "12", 0.071),
    (9, "bot", "0", -1, 0, None, 0.052),
    (2, "top", "12", 0, 0, "3", 0.029),
    (5, "bot", "23", -7, 2, "1", -0.07),
    (8, "bot", "2", -1, 0, "3", 0.084),
    (9, "bot", "0", 0, 0, None, 0.062),
]


@pytest.mark.parametrize("case", PUBLISHED)
def test_published_rewards(spark, case):
    inning, half, base, score, runs, after, want = case
    code = ATTACK[half]
    sign = 1 if code else -1
    rows = [("g", 1, inning, code, sign * score, 1, *bases(base), "OUT")]
    if after is None:
        rows.append(("g", 2, inning + code, 1 - code, sign * (score + runs), 0, 0, 0, 0, "OUT"))
    else:
        rows.append(("g", 2, inning, code, sign * (score + runs), 1, *bases(after), "OUT"))
    first = add_reward(transitions(pa(spark, rows))).where("pa_seq = 1").first()
    assert first.runs_scored == runs and first.inning_ended == (after is None)
    assert first.reward_wpa_computed == pytest.approx(want, abs=1e-9)


def rows_of(frame):
    return {(r.game_id, r.pa_seq): r for r in frame.collect()}


def test_runs_by_half_and_gap(spark):
    got = rows_of(link_transitions(pa(spark, [
        ("a", 1, 1, 0, 0, 0, 0, 0, 0, "HR"),     # away scores: home - away falls to -1
        ("a", 2, 1, 0, -1, 0, 0, 0, 0, "OUT"),   # last of the top, bottom opens at -3
        ("a", 3, 1, 1, -3, 0, 0, 0, 0, "2B"),
        ("a", 4, 1, 1, -1, 1, 1, 1, 1, "BB"),    # last of the bottom, inning 2 is missing
        ("a", 5, 3, 0, 9, 0, 0, 0, 0, "OUT"),    # last of the game
        ("b", 1, 1, 0, 0, 0, 0, 0, 0, "OUT"),    # score moves the wrong way
        ("b", 2, 1, 0, 4, 0, 0, 0, 0, "SF"),     # last of the game
        ("c", 1, 2, 1, 0, 0, 1, 0, 1, "HR"),
    ])))
    runs = {key: (r.runs_scored, r.runs_guessed) for key, r in got.items()}
    assert runs == {
        ("a", 1): (1, False), ("a", 2): (2, False), ("a", 3): (2, False), ("a", 4): (1, True), ("a", 5): (0, True),
        ("b", 1): (0, False), ("b", 2): (1, True), ("c", 1): (3, True),
    }


def test_flags(spark):
    got = rows_of(transitions(pa(spark, [
        ("a", 1, 1, 0, 2, 0, 0, 0, 0, "OUT"),   # opens at 2 and has 7 runs: the opening counts
        ("a", 2, 1, 0, -5, 0, 0, 0, 0, "OUT"),
        ("a", 3, 1, 1, -5, 0, 0, 0, 0, "OUT"),  # opens the bottom at -5
        ("a", 4, 1, 1, 0, 0, 0, 0, 0, "OUT"),   # second of its half
        ("a", 5, 2, 0, 0, 0, 0, 0, 0, "OUT"),
        ("b", 1, 4, 1, 0, 0, 0, 0, 0, "OUT"),
        ("b", 2, 4, 1, 5, 0, 0, 0, 0, "OUT"),
    ])))
    flags = {key: r.data_quality_flag for key, r in got.items()}
    assert flags == {
        ("a", 1): "inning1_nonzero_start", ("a", 2): "", ("a", 3): "inning1_nonzero_start", ("a", 4): "", ("a", 5): "",
        ("b", 1): "high_runs_scored_artifact", ("b", 2): "",
    }


def test_game_ends(spark):
    got = rows_of(transitions(pa(spark, [
        ("walk", 1, 9, 1, 0, 2, 1, 0, 0, "HR"),    # walk-off in inning 9
        ("extra", 1, 10, 1, 0, 2, 1, 0, 0, "HR"),  # a winning run in inning 10 is looked up
        ("draw", 1, 12, 1, 0, 2, 0, 0, 0, "OUT"),  # inning 12 over: drawn, lost, won
        ("lost", 1, 12, 1, -1, 2, 0, 0, 0, "OUT"),
        ("won", 1, 12, 1, 0, 2, 0, 0, 0, "HR"),
        ("top", 1, 12, 0, 0, 2, 0, 0, 0, "OUT"),   # the bottom of inning 12 is still to come
    ])))
    after = {key[0]: r.we_after for key, r in got.items()}
    assert after["walk"] == 1.0 and after["draw"] == 0.5 and after["lost"] == 0.0 and after["won"] == 1.0
    assert after["extra"] == pytest.approx(1 - 0.119) and after["top"] == pytest.approx(1 - 0.512)


def test_order_follows_halves_not_rows(spark):
    """A relay listed under another inning sorts into that inning."""
    got = rows_of(transitions(pa(spark, [
        ("a", 1, 1, 0, 0, 0, 0, 0, 0, "OUT"), ("a", 2, 2, 0, -4, 0, 0, 0, 0, "OUT"),
        ("a", 3, 1, 1, 0, 0, 0, 0, 0, "OUT"), ("a", 4, 1, 0, -1, 1, 0, 0, 0, "OUT"),
    ])))
    assert {k[1]: (r.inning_ended, r.runs_scored) for k, r in got.items()} == {
        1: (False, 1), 4: (True, 0), 3: (True, 0), 2: (True, 0),
    }


def test_fallback_rate_alarm(spark):
    linked = link_transitions(pa(spark, [("a", 1, 3, 1, 0, 0, 0, 0, 0, "1B"), ("b", 1, 3, 1, 0, 0, 0, 0, 0, "OUT")]))
    row = fallback_rate(linked).first()
    assert (row.n_fallback, row.n_doubtful, row.doubtful_rate, row.alarm) == (2, 1, 0.5, True)


def test_contracts(spark):
    states = pa(spark, [("a", 1, 3, 1, 0, 0, 0, 0, 0, "1B")])
    with pytest.raises(ValueError, match="we_after, we_before"):
        add_reward(states)
    with pytest.raises(ValueError, match="pa_result"):
        transitions(states.drop("pa_result"))
    rewards = add_reward(transitions(states))
    assert check_reward(rewards) == 0
    with pytest.raises(ValueError, match="missing on 1"):
        check_reward(rewards.withColumn("reward_wpa_computed", F.lit(None).cast("double")))
