"""The registered queries as plain SQL over the same tables.

Written apart from the DataFrame code: lookups are joins to value tables and the
following half is found by a join, so that the two can disagree.
"""

from __future__ import annotations

from diamondlake.functions import expectancy, labels
from diamondlake.functions.parsing import HIT_SIDES
from diamondlake.operators.profile import CROSSED, NUMERIC, SITUATIONS
from diamondlake.plans.pitch_view import LINE_ORDER, SEQ_STEP

GAME_ID = (
    "concat(CAST((2016 + g % 9) * 10000 + CAST(floor(g / 9.0) AS BIGINT) AS VARCHAR),"
    " CASE WHEN g % 5 = 0 THEN 'LGOB' WHEN g % 2 = 0 THEN 'SKHH' ELSE 'HHSK' END, '0', CAST(2016 + g % 9 AS VARCHAR))"
)


def _r(value: str) -> str:
    return f"round(CAST({value} AS DOUBLE), 6)"


def _p_value(t: str, freedom: str) -> str:
    """Two-sided p of Student's t: one less twice the integral of its density from 0 to |t| (Simpson)."""
    v, n = f"CAST({freedom} AS DOUBLE)", 4000
    density = f"pow(1 + pow(i * abs({t}) / {n}.0, 2) / {v}, -({v} + 1) / 2)"
    area = f"list_sum(list_transform(range(0, {n + 1}), lambda i: (CASE WHEN i IN (0, {n}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {density}))"
    constant = f"exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi())"
    return f"greatest(0, 1 - 2 * {area} * abs({t}) / {3 * n}.0 * {constant})"


def _values(rows: list[tuple]) -> str:
    def literal(value) -> str:
        if isinstance(value, float):
            return f"CAST({value!r} AS DOUBLE)"
        return str(value) if isinstance(value, int) else f"'{value}'"

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def _classify(text: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{label}'" for p, label in labels.RESULT_PATTERNS)
    return f"CASE {cases} ELSE 'UNK' END"


def _hit_side(text: str) -> str:
    cases = " ".join(f"WHEN {text} LIKE '%{word}%' THEN '{side}'" for word, side in HIT_SIDES)
    return f"CASE {cases} END"


def _anchor_rows() -> list[tuple]:
    table = expectancy.load_win_table()
    return [(3, *key, v) for key, v in table.low] + [(7, *key, v) for key, v in table.high]


def _first(column: str) -> str:
    return f"arg_min({column}, seq) FILTER (WHERE {column} IS NOT NULL) AS {column}"


FIRST = [
    "inning", "home_or_away", "pitcher_id", "batter_id", "batter_hit_type", "pitcher_vs_batter_avg",
    "batter_recent_avg", "score_diff", "out_count", "is_base1", "is_base2", "is_base3",
    "total_pitch_count", "inning_pitch_count",
]

# name -> (tables it builds on, select). Together they form one WITH clause.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "placed": ((), """
        SELECT o_orderkey, o_custkey, CAST(floor(o_orderkey / 72.0) AS BIGINT) AS g, CAST(o_orderkey % 72 AS BIGINT) AS p
        FROM orders"""),
    "scored": (("placed",), """
        SELECT q.*, coalesce(sum(CASE WHEN home_or_away = 1 THEN r ELSE -r END)
                 OVER (PARTITION BY g ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               + CASE WHEN g % 13 = 0 THEN 1 ELSE 0 END AS score_diff
        FROM (SELECT placed.*,
                CAST(1 + floor(p / 8.0) + CASE WHEN g % 17 = 1 THEN 3 ELSE 0 END AS INT) AS inning,
                CAST(floor(p / 4.0) % 2 AS INT) AS home_or_away, CAST(p % 4 AS INT) AS b,
                CASE WHEN o_custkey % 500 = 3 THEN 6 WHEN o_custkey % 20 = 0 THEN 1
                     WHEN o_custkey % 20 = 1 THEN 2 ELSE 0 END AS r
              FROM placed) q"""),
    "lines": ((), f"""
        SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS pitch_no
        FROM lineitem"""),
    "pitch": (("scored", "lines"), f"""
        SELECT {GAME_ID} AS game_id, inning, home_or_away, CAST(score_diff AS INT) AS score_diff,
          CAST(CASE WHEN b > 2 THEN 2 ELSE b END AS INT) AS out_count,
          CAST(pitch_no % 4 AS INT) AS ball_count_B, CAST(pitch_no % 3 AS INT) AS ball_count_S,
          CAST(o_custkey % 2 AS INT) AS is_base1, CAST(floor(o_custkey / 2.0) % 2 AS INT) AS is_base2,
          CAST(floor(o_custkey / 4.0) % 2 AS INT) AS is_base3,
          CASE WHEN o_custkey % 97 = 5 THEN NULL ELSE CAST(g * 10 + home_or_away * 4 + CASE WHEN inning > 6 THEN 2 ELSE 0 END
             + CASE WHEN o_custkey % 50 = 7 AND pitch_no > 2 THEN 1 ELSE 0 END AS BIGINT) END AS pitcher_id,
          CAST(g * 100 + home_or_away * 50 + ((inning - 1) * 4 + b) % 9 AS BIGINT) AS batter_id,
          CASE o_custkey % 3 WHEN 0 THEN 'L' WHEN 1 THEN 'R' ELSE NULL END AS batter_hit_type,
          CASE WHEN o_custkey % 23 = 0 THEN NULL ELSE CAST(o_custkey % 11 AS DOUBLE) / 32 END AS pitcher_vs_batter_avg,
          CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE CAST(o_custkey % 13 AS DOUBLE) / 16 END AS batter_recent_avg,
          CASE WHEN l_quantity % 10 = 0 THEN NULL ELSE 110 + l_quantity END AS pitch_speed,
          CASE WHEN pitch_no % 4 = 3 THEN NULL ELSE concat('T', CAST(pitch_no % 4 AS VARCHAR)) END AS pitch_type,
          CASE WHEN l_quantity % 17 = 0 THEN NULL ELSE 'H' END AS pitch_result,
          CASE o_custkey % 14 WHEN 0 THEN '좌월 홈런' WHEN 1 THEN '우중간 3루타' WHEN 2 THEN '좌익수 왼쪽 2루타'
            WHEN 3 THEN '중견수 앞 1루타' WHEN 4 THEN '고의사구' WHEN 5 THEN '볼넷' WHEN 6 THEN '몸에 맞는 공'
            WHEN 7 THEN '헛스윙 삼진 아웃' WHEN 8 THEN '2루수 병살타 아웃' WHEN 9 THEN '우익수 희생플라이 아웃'
            WHEN 10 THEN '유격수 땅볼 아웃' WHEN 11 THEN '중견수 뜬공 아웃' WHEN 12 THEN '' ELSE '기타' END AS relay_text,
          CASE WHEN g % 9 = 0 THEN CAST(o_custkey % 41 - 20 AS DOUBLE) END AS reward_wpa,
          p * {SEQ_STEP} + pitch_no AS seq
        FROM lines JOIN scored ON l_orderkey = o_orderkey"""),
    "numbered": (("pitch",), """
        SELECT *, CAST(sum(starts) OVER (PARTITION BY game_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS pa_seq
        FROM (SELECT *, CASE WHEN inning = lag(inning) OVER w AND pitcher_id = lag(pitcher_id) OVER w
                             AND batter_id = lag(batter_id) OVER w THEN 0 ELSE 1 END AS starts
              FROM pitch WINDOW w AS (PARTITION BY game_id ORDER BY seq))"""),
    "counted": (("numbered",), """
        SELECT * EXCLUDE (prev_inning, run, total_count),
          CAST(total_count AS INT) AS total_pitch_count,
          CAST(row_number() OVER (PARTITION BY game_id, pitcher_id, run ORDER BY seq) AS INT) AS inning_pitch_count
        FROM (SELECT *, sum(CASE WHEN prev_inning = inning THEN 0 ELSE 1 END) OVER (PARTITION BY game_id, pitcher_id ORDER BY seq) AS run
              FROM (SELECT *, row_number() OVER w AS total_count, lag(inning) OVER w AS prev_inning
                    FROM numbered WINDOW w AS (PARTITION BY game_id, pitcher_id ORDER BY seq)))"""),
    "speeds": (("counted",), """
        SELECT *, CASE WHEN pitch_speed IS NOT NULL THEN round_even(avg(pitch_speed) OVER (
            PARTITION BY game_id, pitcher_id, pitch_speed IS NULL ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 2) END
          AS recent_5_pitch_speed_avg
        FROM counted"""),
    "pa": (("counted",), f"""
        SELECT game_id, pa_seq, {', '.join(_first(c) for c in FIRST)},
          arg_max(pa_result, seq) AS pa_result,
          arg_max(reward_wpa, seq) FILTER (WHERE reward_wpa IS NOT NULL) AS reward_wpa,
          count(pitch_result) AS pitches_per_pa, avg(pitch_speed) AS pa_avg_pitch_speed
        FROM (SELECT *, {_classify('relay_text')} AS pa_result FROM counted)
        GROUP BY game_id, pa_seq"""),
    "anchor": ((), f"SELECT * FROM (VALUES {_values(_anchor_rows())}) t(anchor, half, base, score, v)"),
    "we": (("anchor",), """
        SELECT CAST(i AS INT) AS inning, lo.half, lo.base, lo.score,
          (CAST(1 AS DOUBLE) - (i - 3) / CAST(4 AS DOUBLE)) * lo.v + ((i - 3) / CAST(4 AS DOUBLE)) * hi.v AS we
        FROM anchor lo JOIN anchor hi ON lo.anchor = 3 AND hi.anchor = 7 AND lo.half = hi.half AND lo.base = hi.base AND lo.score = hi.score,
          range(3, 8) r(i)"""),
    "re": ((), "SELECT * FROM (VALUES " + _values(
        [(base, outs, v) for base, cells in expectancy.RUN_EXPECTANCY.items() for outs, v in enumerate(cells)]
    ) + ") t(base, outs, re)"),
    "before": (("pa", "we"), """
        SELECT s.*, CASE WHEN inning9 AND attack > 0 THEN 1.0
            WHEN s.inning >= 12 AND out_count >= 3 THEN CASE WHEN attack > 0 THEN 1.0 WHEN attack < 0 THEN 0.0 ELSE 0.5 END
            ELSE we.we END AS we_before
        FROM (SELECT *, attack AS score_diff_attacker, inning = 9 AND half = 'bot' AS inning9
              FROM (SELECT pa.*, CASE is_base1 + 2 * is_base2 + 4 * is_base3 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2'
                       WHEN 3 THEN '12' WHEN 4 THEN '3' WHEN 5 THEN '13' WHEN 6 THEN '23' ELSE '123' END AS base_state,
                     CASE home_or_away WHEN 0 THEN 'top' WHEN 1 THEN 'bot' END AS half,
                     CASE WHEN home_or_away = 1 THEN score_diff ELSE -score_diff END AS attack FROM pa)) s
        LEFT JOIN we ON we.inning = greatest(3, least(7, s.inning)) AND we.half = s.half
          AND we.score = greatest(-4, least(4, attack)) AND we.base = s.base_state"""),
    "halves": (("pa",), """
        SELECT game_id, inning, home_or_away, arg_min(score_diff, pa_seq) AS first_score, max(pa_seq) AS last_pa, min(pa_seq) AS first_pa
        FROM pa GROUP BY game_id, inning, home_or_away"""),
    "linked": (("before", "halves"), """
        SELECT b.*, lead(b.score_diff) OVER w AS next_score, lead(b.out_count) OVER w AS next_outs, lead(b.base_state) OVER w AS next_base,
          b.pa_seq = h.last_pa AS inning_ended, b.pa_seq = h.first_pa AS half_opened, n.first_score AS follow_score
        FROM before b
        JOIN halves h ON b.game_id = h.game_id AND b.inning = h.inning AND b.home_or_away = h.home_or_away
        LEFT JOIN halves n ON n.game_id = b.game_id AND n.inning = b.inning + b.home_or_away AND n.home_or_away = 1 - b.home_or_away
        WINDOW w AS (PARTITION BY b.game_id, b.inning, b.home_or_away ORDER BY b.pa_seq)"""),
    "ran": (("linked",), """
        SELECT *, inning_ended AND follow_score IS NULL AS runs_guessed,
          CAST(greatest(0, CASE
            WHEN NOT inning_ended THEN CASE WHEN home_or_away = 1 THEN next_score - score_diff ELSE score_diff - next_score END
            WHEN follow_score IS NOT NULL THEN CASE WHEN home_or_away = 1 THEN follow_score - score_diff ELSE score_diff - follow_score END
            WHEN pa_result = 'HR' THEN 1 + is_base1 + is_base2 + is_base3
            WHEN pa_result = 'SF' THEN 1
            WHEN pa_result IN ('BB', 'IBB', 'HBP') AND is_base1 + is_base2 + is_base3 = 3 THEN 1
            ELSE 0 END) AS INT) AS runs_scored
        FROM linked"""),
    "asked": (("ran",), """
        SELECT *, attack + runs_scored AS after,
          CASE WHEN inning_ended THEN inning + home_or_away ELSE inning END AS q_inning,
          CASE WHEN NOT inning_ended THEN half WHEN half = 'top' THEN 'bot' ELSE 'top' END AS q_half,
          CASE WHEN inning_ended THEN -(attack + runs_scored) ELSE attack + runs_scored END AS q_score,
          CASE WHEN inning_ended THEN '0' ELSE next_base END AS q_base,
          CASE WHEN inning_ended THEN 0 ELSE next_outs END AS q_outs
        FROM ran"""),
    "valued": (("asked", "we"), """
        SELECT a.*, CASE
            WHEN inning_ended AND a.inning = 9 AND a.half = 'bot' AND after > 0 THEN 1.0
            WHEN inning_ended AND q_inning > 12 THEN CASE WHEN after > 0 THEN 1.0 WHEN after < 0 THEN 0.0 ELSE 0.5 END
            WHEN inning_ended THEN 1.0 - looked ELSE looked END AS we_after,
          CASE WHEN a.inning = 1 AND half_opened AND score_diff <> 0 THEN 'inning1_nonzero_start'
            WHEN runs_scored >= 5 THEN 'high_runs_scored_artifact' ELSE '' END AS data_quality_flag
        FROM (SELECT asked.*, CASE WHEN q_inning = 9 AND q_half = 'bot' AND q_score > 0 THEN 1.0
                WHEN q_inning >= 12 AND q_outs >= 3 THEN CASE WHEN q_score > 0 THEN 1.0 WHEN q_score < 0 THEN 0.0 ELSE 0.5 END
                ELSE we.we END AS looked
              FROM asked LEFT JOIN we ON we.inning = greatest(3, least(7, q_inning)) AND we.half = q_half
                AND we.score = greatest(-4, least(4, q_score)) AND we.base = q_base) a"""),
    "wpa": (("valued",), "SELECT *, we_after - we_before AS reward_wpa_computed FROM valued"),
    "clean": (("wpa",), "SELECT * FROM wpa WHERE data_quality_flag = ''"),
    "pairs": (("wpa",), "SELECT * FROM wpa WHERE reward_wpa IS NOT NULL"),
    # ---- documents --------------------------------------------------------------
    "ro": ((), f"""
        SELECT *, {GAME_ID} AS game_id, CAST(1 + floor(p / 8.0) + CASE WHEN g % 19 = 2 THEN 6 ELSE 0 END AS INT) AS req_inning,
          CAST(floor(p / 4.0) % 2 AS INT) AS code
        FROM (SELECT o_custkey AS c, CAST(floor(o_orderkey / 72.0) AS BIGINT) AS g, CAST(o_orderkey % 72 AS BIGINT) AS p FROM orders)"""),
    "docs": (("ro",), """
        SELECT g, game_id, req_inning, count(*) AS relays, (g % 7 = 3 AND req_inning = 6) OR (g % 11 = 5 AND req_inning = 1)
          OR (g % 8 = 1 AND req_inning = 8) AS is_empty,
          NOT ((g % 7 = 3 AND req_inning = 6) OR (g % 11 = 5 AND req_inning = 1) OR (g % 8 = 1 AND req_inning = 8))
            AND ((g % 23 = 9 AND req_inning = 4) OR (g % 23 = 10 AND req_inning = 5)) AS is_broken
        FROM ro WHERE NOT (g % 13 = 4 AND req_inning = 3) GROUP BY g, game_id, req_inning"""),
    "kept": (("docs",), """
        SELECT g, game_id, req_inning, CASE WHEN is_empty THEN 0 ELSE relays END AS n_relays, is_empty
        FROM (SELECT *, min(CASE WHEN is_empty AND req_inning > 1 THEN req_inning END) OVER (PARTITION BY g) AS stop
              FROM docs WHERE req_inning <= 12)
        WHERE req_inning < coalesce(stop, 13) AND NOT is_broken"""),
    "rp": (("ro", "kept"), """
        SELECT *, CASE k % 6 WHEN 0 THEN 140.0 + i WHEN 1 THEN 145.5 END AS pitch_speed,
          CASE WHEN k % 3 = 0 THEN 'FAST' END AS pitch_type,
          CASE WHEN k % 11 IN (1, 2) THEN NULL ELSE 'S' END AS pitch_result
        FROM (SELECT ro.*, i, c + i AS k FROM ro JOIN kept ON kept.g = ro.g AND kept.req_inning = ro.req_inning AND NOT kept.is_empty,
                unnest(range(1, c % 7 + 1)) AS u(i) WHERE c % 29 <> 0)
        WHERE k % 19 <> 0 AND k % 11 <> 0"""),
    "rpitch": (("rp",), f"""
        SELECT g, p, i, game_id, req_inning, CASE WHEN c % 59 = 2 THEN NULL ELSE req_inning END AS inning, code AS home_or_away,
          CAST((CASE WHEN c % 10 IN (0, 1) THEN 0 ELSE c % 9 END) - c % 7 AS INT) AS score_diff,
          CAST(CASE c % 4 WHEN 3 THEN 0 WHEN 2 THEN NULL ELSE c % 3 END AS INT) AS out_count,
          CAST(i % 4 AS INT) AS ball_count_B, 2 AS ball_count_S,
          CASE WHEN c % 5 = 2 THEN 1 ELSE 0 END AS is_base1, 0 AS is_base2, CASE WHEN c % 2 = 0 THEN 1 ELSE 0 END AS is_base3,
          CASE c % 8 WHEN 0 THEN '' WHEN 1 THEN 'None' WHEN 2 THEN '1001' ELSE CAST(2000 + code AS VARCHAR) END AS pitcher_text,
          CAST(5000 + p AS VARCHAR) AS batter_text,
          CASE WHEN has_record THEN CASE c % 5 WHEN 0 THEN 'L' WHEN 1 THEN 'R' WHEN 2 THEN 'S' END
               WHEN late_record THEN 'S' END AS batter_hit_type,
          CASE WHEN has_record THEN CASE c % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 ELSE 0.75 END
               WHEN late_record THEN 0.9 ELSE 0.0 END AS pitcher_vs_batter_avg,
          CASE WHEN has_record THEN CASE c % 6 WHEN 1 THEN 0.0 WHEN 4 THEN 0.25
                 ELSE CASE c % 4 WHEN 0 THEN 0.3 WHEN 1 THEN 0.125 ELSE 0.0 END END
               WHEN late_record THEN 0.9 ELSE 0.0 END AS batter_recent_avg,
          pitch_speed, pitch_type, pitch_result,
          CASE WHEN c % 43 = 0 THEN NULL ELSE CASE c % 14 WHEN 0 THEN '좌월 홈런' WHEN 5 THEN '볼넷' WHEN 7 THEN '헛스윙 삼진 아웃'
               WHEN 12 THEN NULL ELSE '기타' END END AS relay_text,
          CASE WHEN c % 3 = 0 THEN CAST(concat(CAST(c % 41 - 20 AS VARCHAR), '.5') AS DOUBLE) END AS reward_wpa
        FROM (SELECT *, c % 41 <> 0 AND c % 37 <> 0 AS has_record, c % 41 = 0 AND c % 61 = 0 AS late_record FROM rp)"""),
    "rtable": (("rpitch",), """
        SELECT * EXCLUDE (prev_inning, run, total_count, pitcher_text, batter_text),
          CAST(CASE WHEN pitcher_text IN ('', 'None') THEN NULL ELSE pitcher_text END AS BIGINT) AS pitcher_id,
          CAST(batter_text AS BIGINT) AS batter_id,
          CAST(total_count AS INT) AS total_pitch_count,
          CAST(row_number() OVER (PARTITION BY game_id, pitcher_text, run ORDER BY req_inning, home_or_away, p, i) AS INT) AS inning_pitch_count,
          CASE WHEN pitch_speed IS NOT NULL THEN round_even(avg(pitch_speed) OVER (
            PARTITION BY game_id, pitcher_text, pitch_speed IS NULL ORDER BY req_inning, home_or_away, p, i
            ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 2) END AS recent_5_pitch_speed_avg
        FROM (SELECT *, sum(CASE WHEN prev_inning = inning THEN 0 ELSE 1 END)
                OVER (PARTITION BY game_id, pitcher_text ORDER BY req_inning, home_or_away, p, i) AS run
              FROM (SELECT *, row_number() OVER w AS total_count, lag(inning) OVER w AS prev_inning FROM rpitch WHERE inning IS NOT NULL
                    WINDOW w AS (PARTITION BY game_id, pitcher_text ORDER BY req_inning, home_or_away, p, i)))"""),
    "schedule_list": (("ro",), """
        SELECT DISTINCT game_id FROM ro WHERE g % 7 <> 0 AND g % 11 <> 0 AND g % 5 <> 0"""),
    # ---- figures of the validation ----------------------------------------------
    "selfc": (("wpa",), """
        SELECT *, coalesce(hr_mean > b1_mean AND b1_mean > bb_mean AND bb_mean > 0 AND 0 > out_mean, false) AS domain_ok
        FROM (SELECT count(*) FILTER (WHERE reward_wpa_computed IS NULL) AS missing,
                count(*) FILTER (WHERE abs(reward_wpa_computed) > 1) AS out_of_range, avg(reward_wpa_computed) AS grand_mean,
                avg(reward_wpa_computed) FILTER (WHERE pa_result = 'HR') AS hr_mean,
                avg(reward_wpa_computed) FILTER (WHERE pa_result = '1B') AS b1_mean,
                avg(reward_wpa_computed) FILTER (WHERE pa_result = 'BB') AS bb_mean,
                avg(reward_wpa_computed) FILTER (WHERE pa_result = 'OUT') AS out_mean FROM wpa)"""),
    "signs": (("pairs",), """
        SELECT count(*) AS n_signed, avg(CASE WHEN sign(reward_wpa) = sign(reward_wpa_computed) THEN 1.0 ELSE 0.0 END) AS sign_match_rate
        FROM pairs WHERE reward_wpa <> 0 AND reward_wpa_computed <> 0"""),
    "lin": (("pairs",), f"""
        SELECT *, {_p_value('t', 'n - 2')} AS p FROM (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM (
          SELECT count(*) AS n, corr(reward_wpa, reward_wpa_computed) AS r FROM pairs))"""),
    "rank": (("pairs",), f"""
        SELECT *, {_p_value('t', 'n - 2')} AS p FROM (SELECT *, rho * sqrt((n - 2) / (1 - rho * rho)) AS t FROM (
          SELECT count(*) AS n, corr(x, y) AS rho FROM (
          SELECT rank() OVER (ORDER BY reward_wpa) + (count(*) OVER (PARTITION BY reward_wpa) - 1) / 2.0 AS x,
                 rank() OVER (ORDER BY reward_wpa_computed) + (count(*) OVER (PARTITION BY reward_wpa_computed) - 1) / 2.0 AS y
          FROM pairs)))"""),
    "flags": (("wpa",), """
        SELECT flag, count(pa_seq) AS n, avg(reward_wpa_computed) AS mean, stddev_samp(reward_wpa_computed) AS std
        FROM (VALUES ('inning1_nonzero_start', 'inning1_nonzero_start'), ('high_runs_scored_artifact', 'high_runs_scored_artifact'),
              ('normal', '')) f(flag, code) LEFT JOIN wpa ON data_quality_flag = code GROUP BY flag"""),
    "judged": (("selfc", "signs", "rank"), """
        SELECT *, CASE WHEN missing = 0 THEN 1 ELSE 0 END AS ok1, CASE WHEN out_of_range = 0 THEN 1 ELSE 0 END AS ok2,
          CASE WHEN sign_match_rate >= 0.8 THEN 1 ELSE 0 END AS ok3,
          CASE WHEN rho >= 0.6 AND p < 0.05 THEN 1 ELSE 0 END AS ok4,
          CASE WHEN domain_ok THEN 1 ELSE 0 END AS ok5
        FROM selfc, signs, rank"""),
    "judged_rows": (("judged",), """
        SELECT CAST(number AS INT) AS number, criterion, threshold,
          CAST(CASE number WHEN 1 THEN missing WHEN 2 THEN out_of_range WHEN 3 THEN sign_match_rate WHEN 4 THEN rho
             ELSE CASE WHEN domain_ok THEN 1 ELSE 0 END END AS DOUBLE) AS value,
          CASE WHEN [ok1, ok2, ok3, ok4, ok5][number] = 1 THEN 'PASS' ELSE 'FAIL' END AS result,
          CAST(ok1 + ok2 + ok3 + ok4 + ok5 AS INT) AS n_pass,
          CASE WHEN ok1 + ok2 + ok3 + ok4 + ok5 = 5 THEN 'complete'
            WHEN sign_match_rate < 0.5 OR (sign_match_rate < 0.8 AND rho < 0.6) THEN 'sign error suspected' ELSE 'refine' END AS conclusion
        FROM judged, (VALUES (1, 'missing', '= 0'), (2, 'out_of_range', '= 0'), (3, 'sign_match_rate', '>= 0.80'),
          (4, 'spearman', '>= 0.6, p < 0.05'), (5, 'label_order', 'HR>1B>BB>0>OUT')) v(number, criterion, threshold)"""),
    "moves": (("pa",), """
        SELECT game_id, inning, home_or_away, coalesce(bool_or(step > 0), false) AS any_up, coalesce(bool_or(step < 0), false) AS any_down
        FROM (SELECT *, score_diff - lag(score_diff) OVER (PARTITION BY game_id, inning, home_or_away ORDER BY pa_seq) AS step FROM pa)
        GROUP BY game_id, inning, home_or_away"""),
    "widest": (("pa",), """
        SELECT game_id, max(score_diff) - min(score_diff) AS score_range FROM pa GROUP BY game_id
        ORDER BY score_range DESC, game_id LIMIT 1"""),
    "opening": (("pa",), """
        SELECT game_id, home_or_away, arg_min(score_diff, pa_seq) AS score_diff, arg_min(pa_result, pa_seq) AS pa_result
        FROM pa WHERE inning = 1 AND out_count = 0 AND is_base1 = 0 AND is_base2 = 0 AND is_base3 = 0
        GROUP BY game_id, home_or_away"""),
}


def _sql(tables: str, body: str) -> str:
    done: list[str] = []

    def need(name: str) -> None:
        for other in CTES[name][0]:
            need(other)
        if name not in done:
            done.append(name)

    for table in tables.split():
        need(table)
    if not done:
        return body
    parts = ",\n".join(f'"{name}" AS ({CTES[name][1]})' for name in done)
    return f"WITH {parts}\n{body}"


def _select(columns: list[str], doubles: set[str]) -> str:
    return ", ".join(f"{_r(c)} AS {c}" if c in doubles else c for c in columns)


PA_COLUMNS = ["game_id", "pa_seq", *FIRST, "pa_result", "reward_wpa", "pitches_per_pa", "pa_avg_pitch_speed"]
PA_DOUBLES = {"pitcher_vs_batter_avg", "batter_recent_avg", "reward_wpa", "pa_avg_pitch_speed"}
STATE_COLUMNS = ["base_state", "half", "score_diff_attacker", "we_before", "runs_scored", "inning_ended", "we_after", "data_quality_flag"]
STATE_DOUBLES = {"we_before", "we_after"}
PITCH = [
    "game_id", "inning", "home_or_away", "score_diff", "out_count", "ball_count_B", "ball_count_S", "is_base1", "is_base2", "is_base3",
    "pitcher_id", "batter_id", "batter_hit_type", "pitcher_vs_batter_avg", "batter_recent_avg", "pitch_speed", "pitch_type",
    "total_pitch_count", "recent_5_pitch_speed_avg", "inning_pitch_count", "pitch_result", "relay_text", "reward_wpa",
]
PITCH_DOUBLES = {"pitcher_vs_batter_avg", "batter_recent_avg", "pitch_speed", "recent_5_pitch_speed_avg", "reward_wpa"}


def _describe(keys: str, value: str, source: str) -> str:
    group = f" GROUP BY {keys}" if keys else ""
    key = f"{keys}, " if keys else ""
    return f"""SELECT {key}count({value}) AS n, count(*) FILTER (WHERE {value} IS NULL) AS missing,
      {_r(f'avg({value})')} AS mean, {_r(f'stddev_samp({value})')} AS std,
      {_r(f'CAST(min({value}) AS DOUBLE)')} AS min, {_r(f'CAST(max({value}) AS DOUBLE)')} AS max,
      {', '.join(f"{_r(f'quantile_cont(CAST({value} AS DOUBLE), {q})')} AS {n}" for q, n in ((.25, 'q25'), (.5, 'q50'), (.75, 'q75')))}
      FROM {source}{group}"""


def _counts(value: str, source: str, label: str | None = None) -> str:
    return f"""SELECT {value} AS {label or value}, count(*) AS n, {_r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct
      FROM {source} GROUP BY {value}"""


def _long(columns: list[str], source: str, keep: str = "") -> str:
    extra = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS dimension, CAST({c} AS VARCHAR) AS value FROM {source}" for c in columns
    )


def _row_level(columns: str, source: str) -> str:
    return f"SELECT game_id, pa_seq, {columns} FROM {source}"


FEATURE_ROWS = """game_id, pa_seq, inning, half, score_diff_attacker, base_state, out_count, total_pitch_count, inning_pitch_count,
  batter_hit_type, pitcher_id, batter_id, pa_result, """ + f"{_r('reward_wpa_computed')} AS reward_wpa_computed"

# name -> (tables, select)
BODIES: dict[str, tuple[str, str]] = {
    "relay_scan": ("docs", """SELECT game_id, count(*) AS n_documents, min(req_inning) AS first_inning, max(req_inning) AS last_inning
      FROM docs GROUP BY game_id"""),
    "inning_cutoff": ("kept", "SELECT game_id, req_inning, n_relays FROM kept"),
    "relay_explode": ("ro docs", """
      SELECT game_id, req_inning, CAST(sum(batter + pitches + result + again) AS BIGINT) AS n_options,
        CAST(sum(batter + again) AS BIGINT) AS n_batter, CAST(sum(typed) AS BIGINT) AS n_pitch, CAST(sum(result) AS BIGINT) AS n_result,
        CAST(max(CASE WHEN batter + pitches + result + again > 0 THEN place END) AS INT) AS last_relay,
        CAST(max(batter + pitches + result + again) - 1 AS INT) AS last_option
      FROM (SELECT ro.*, row_number() OVER (PARTITION BY ro.g, ro.req_inning ORDER BY code, p DESC) - 1 AS place,
              CASE WHEN c % 29 = 0 OR c % 41 = 0 THEN 0 ELSE 1 END AS batter,
              CASE WHEN c % 29 = 0 THEN 0 ELSE c % 7 END AS pitches,
              CASE WHEN c % 29 = 0 THEN 0 ELSE len(list_filter(range(1, c % 7 + 1), lambda i: (c + i) % 19 <> 0)) END AS typed,
              CASE WHEN c % 29 = 0 OR c % 43 = 0 THEN 0 ELSE 1 END AS result,
              CASE WHEN c % 29 <> 0 AND c % 61 = 0 THEN 1 ELSE 0 END AS again
            FROM ro JOIN docs ON docs.g = ro.g AND docs.req_inning = ro.req_inning AND NOT is_empty AND NOT is_broken AND ro.req_inning <= 12)
      GROUP BY game_id, req_inning HAVING sum(batter + pitches + result + again) > 0"""),
    "pitch_rows": ("rpitch", f"SELECT {_select([c for c in PITCH if c not in ('total_pitch_count', 'recent_5_pitch_speed_avg', 'inning_pitch_count', 'pitcher_id', 'batter_id')], PITCH_DOUBLES)}, pitcher_text, batter_text FROM rpitch"),
    "pitch_seq": ("rpitch", """SELECT game_id, row_number() OVER (PARTITION BY game_id ORDER BY req_inning, home_or_away, p, i) AS place,
      batter_text, ball_count_B, home_or_away FROM rpitch"""),
    "pitch_rejects": ("rpitch docs", """SELECT game_id, reason, count(*) AS n_rejected FROM (
        SELECT game_id, 'inning' AS reason FROM rpitch WHERE inning IS NULL
        UNION ALL SELECT game_id, 'inning' FROM docs WHERE req_inning > 12
        UNION ALL SELECT game_id, 'payload' FROM docs WHERE is_broken) GROUP BY game_id, reason"""),
    "pitch_table": ("rtable", f"SELECT {_select(PITCH, PITCH_DOUBLES)} FROM rtable"),
    "safe_casts": ("rpitch", f"""SELECT score_diff, {_r('pitch_speed')} AS pitch_speed, is_base1, is_base2, is_base3,
      {_r('pitcher_vs_batter_avg')} AS pitcher_vs_batter_avg, {_r('batter_recent_avg')} AS batter_recent_avg, count(*) AS n
      FROM rpitch GROUP BY ALL"""),
    "hit_type": ("", f"""SELECT handedness, {_hit_side('handedness')} AS side, count(*) AS n FROM (
      SELECT CASE o_custkey % 7 WHEN 0 THEN '우투좌타' WHEN 1 THEN '좌투좌타' WHEN 2 THEN '우투우타' WHEN 3 THEN '좌투우타'
        WHEN 4 THEN '우투양타' WHEN 5 THEN '' ELSE NULL END AS handedness FROM orders) GROUP BY handedness"""),
    "schedule_ids": ("schedule_list", "SELECT game_id FROM schedule_list"),
    "id_list": ("ro", "SELECT game_id, count(*) AS n_lines FROM ro WHERE p % 3 = 0 GROUP BY game_id"),
    "month_windows": ("", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day, last_day(o_orderdate) AS last_day, count(*) AS n_orders
      FROM orders WHERE month(o_orderdate) BETWEEN 3 AND 11 GROUP BY 1, 2"""),
    "csv_roundtrip": ("speeds", f"""SELECT {_select([c for c in PITCH if c != 'relay_text'], PITCH_DOUBLES)}, nullif(relay_text, '') AS relay_text, seq
      FROM speeds"""),
    "pitch_order_cols": ("pitch", "SELECT game_id, inning, pitch_speed, reward_wpa, seq FROM pitch"),
    "game_id_parts": ("ro", """SELECT DISTINCT game_id, CAST(try_strptime(substr(game_id, 1, 8), '%Y%m%d') AS DATE) AS game_date,
      substr(game_id, 9, 2) AS away_team, substr(game_id, 11, 2) AS home_team, CAST(substr(game_id, 13, 1) AS INT) AS game_number,
      substr(game_id, 14, 4) AS season FROM ro"""),
    "listed_semi": ("pitch schedule_list", """SELECT game_id, count(*) AS n_pitches FROM pitch
      WHERE game_id IN (SELECT game_id FROM schedule_list) GROUP BY game_id"""),
    "resume_anti": ("pitch ro", """SELECT game_id, count(*) AS n_pitches FROM pitch
      WHERE game_id NOT IN (SELECT game_id FROM ro WHERE g % 2 = 0) GROUP BY game_id"""),
    "pa_seq": ("numbered", "SELECT game_id, seq, pa_seq FROM numbered"),
    "pitch_counts": ("counted", "SELECT game_id, seq, total_pitch_count, inning_pitch_count FROM counted"),
    "recent_speed_avg": ("speeds", f"SELECT game_id, seq, {_r('recent_5_pitch_speed_avg')} AS recent_5_pitch_speed_avg FROM speeds"),
    "classify_result": ("pitch", f"SELECT relay_text, {_classify('relay_text')} AS pa_result, count(*) AS n FROM pitch GROUP BY relay_text"),
    "runs_from_text": ("", r"""SELECT relay_text, n, CAST(CASE WHEN regexp_matches(relay_text, '만루\s*홈런') THEN 4
        WHEN regexp_matches(relay_text, '3점\s*홈런|쓰리런') THEN 3 WHEN regexp_matches(relay_text, '2점\s*홈런|투런') THEN 2
        WHEN relay_text LIKE '%홈런%' THEN 1
        ELSE coalesce(TRY_CAST(regexp_extract(relay_text, '(\d+)점', 1) AS INT), 0) END AS INT) AS runs
      FROM (SELECT relay_text, count(*) AS n FROM (
        SELECT CASE o_custkey % 11 WHEN 0 THEN '만루  홈런' WHEN 1 THEN '만루홈런' WHEN 2 THEN '좌월 3점 홈런' WHEN 3 THEN '쓰리런'
          WHEN 4 THEN '2점홈런' WHEN 5 THEN '투런' WHEN 6 THEN '우월 홈런' WHEN 7 THEN concat(CAST(o_custkey % 13 AS VARCHAR), '점 적시타')
          WHEN 8 THEN '  ' WHEN 9 THEN NULL ELSE '땅볼' END AS relay_text FROM orders) GROUP BY relay_text)"""),
    "pa_aggregate": ("pa", f"SELECT {_select(PA_COLUMNS, PA_DOUBLES)} FROM pa"),
    "pa_states": ("before", _row_level(f"base_state, half, score_diff_attacker, {_r('we_before')} AS we_before", "before")),
    "re_lookup": ("before re", f"""SELECT game_id, pa_seq, s.outs, {_r('CASE WHEN s.outs >= 3 THEN 0.0 ELSE re.re END')} AS re
      FROM (SELECT *, out_count + inning % 3 AS outs FROM before) s LEFT JOIN re ON re.outs = s.outs AND re.base = base_state"""),
    "we_lookup": ("before we", f"""SELECT game_id, pa_seq, {_r('we.we')} AS we FROM before b LEFT JOIN we
      ON we.inning = greatest(3, least(7, b.inning)) AND we.half = b.half AND we.score = greatest(-4, least(4, attack)) AND we.base = base_state"""),
    "we_boundary": ("before we", f"""SELECT game_id, pa_seq, {_r('''CASE WHEN inning9 AND attack > 0 THEN 1.0
        WHEN b.inning >= 12 AND out_count + pa_seq % 3 >= 3 THEN CASE WHEN attack > 0 THEN 1.0 WHEN attack < 0 THEN 0.0 ELSE 0.5 END
        ELSE we.we END''')} AS we FROM before b LEFT JOIN we
      ON we.inning = greatest(3, least(7, b.inning)) AND we.half = b.half AND we.score = greatest(-4, least(4, attack)) AND we.base = base_state"""),
    "we_out_adjusted": ("before we re", f"""SELECT game_id, pa_seq,
        {_r('greatest(0.0, least(1.0, we.we + 0.25 * (r.re - r1.re)))')} AS we FROM before b LEFT JOIN we
      ON we.inning = greatest(3, least(7, b.inning)) AND we.half = b.half AND we.score = greatest(-4, least(4, attack)) AND we.base = base_state
      LEFT JOIN re r ON r.base = base_state AND r.outs = out_count LEFT JOIN re r1 ON r1.base = base_state AND r1.outs = 1"""),
    "pa_next_state": ("linked", _row_level("next_score, next_outs, next_base", "linked")),
    "inning_ended": ("linked", _row_level("inning_ended", "linked")),
    "runs_scored": ("ran", _row_level("runs_scored, runs_guessed", "ran")),
    "we_after": ("valued", _row_level(f"{_r('we_after')} AS we_after", "valued")),
    "quality_flag": ("valued", _row_level("data_quality_flag", "valued")),
    "runs_fallback_rate": ("ran", f"""SELECT n_fallback, n_doubtful, {_r('coalesce(n_doubtful / nullif(n_fallback, 0), 0.0)')} AS doubtful_rate,
        coalesce(n_doubtful / nullif(n_fallback, 0), 0.0) > 0.1 AS alarm
      FROM (SELECT count(*) FILTER (WHERE runs_guessed) AS n_fallback, count(*) FILTER (WHERE runs_guessed AND runs_scored = 0
        AND pa_result NOT IN ('OUT', 'SO', 'GDP', 'UNK', 'BB', 'IBB', 'HBP', 'SF')) AS n_doubtful FROM ran)"""),
    "state_checks": ("valued", """SELECT count(*) AS n_rows, count(*) - count(we_before) AS we_before_missing, count(*) - count(we_after) AS we_after_missing,
        count(*) - count(runs_scored) AS runs_scored_missing, count(*) FILTER (WHERE we_before NOT BETWEEN 0 AND 1) AS we_before_outside,
        count(*) FILTER (WHERE we_after NOT BETWEEN 0 AND 1) AS we_after_outside, count(*) FILTER (WHERE runs_scored < 0) AS negative_runs,
        count(DISTINCT (game_id, inning, home_or_away)) AS n_halves, count(*) FILTER (WHERE inning_ended) AS n_ended,
        count(*) FILTER (WHERE data_quality_flag = 'inning1_nonzero_start') AS n_nonzero_start FROM valued"""),
    "half_inning_check": ("linked", """SELECT *, n_halves = n_ended AS halves_match FROM (
        SELECT count(DISTINCT game_id) AS n_games, count(*) AS n_rows, count(DISTINCT (game_id, inning, home_or_away)) AS n_halves,
          count(*) FILTER (WHERE inning_ended) AS n_ended FROM linked)"""),
    "pa_wpa": ("wpa", f"""SELECT {_select(PA_COLUMNS + STATE_COLUMNS + ['reward_wpa_computed'], PA_DOUBLES | STATE_DOUBLES | {'reward_wpa_computed'})}
      FROM wpa"""),
    "wpa_by_result": ("wpa", f"""SELECT pa_result, count(*) AS n, {_r('avg(reward_wpa_computed)')} AS mean_reward,
        CAST(list_position({labels.LABEL_ORDER!r}, pa_result) AS INT) AS label_rank FROM wpa GROUP BY pa_result"""),
    "wpa_self_check": ("selfc", f"""SELECT missing, out_of_range,
        {', '.join(f"{_r(c)} AS {c}" for c in ('grand_mean', 'hr_mean', 'b1_mean', 'bb_mean', 'out_mean'))}, domain_ok FROM selfc"""),
    "season_counts": ("pairs", "SELECT substr(game_id, 1, 4) AS season, count(*) AS n_pa FROM pairs GROUP BY 1"),
    "wpa_describe": ("clean", _describe("", "reward_wpa_computed", "clean")),
    "provider_describe": ("pairs", _describe("", "reward_wpa", "pairs")),
    "sign_match": ("signs", f"SELECT n_signed, {_r('sign_match_rate')} AS sign_match_rate FROM signs"),
    "wpa_pearson": ("lin", f"SELECT n, {_r('r')} AS r, {_r('t')} AS t, {_r('p')} AS p FROM lin"),
    "wpa_spearman": ("rank", f"SELECT n, {_r('rho')} AS rho, {_r('t')} AS t, {_r('p')} AS p FROM rank"),
    "flag_stats": ("flags", f"SELECT flag, n, {_r('mean')} AS mean, {_r('std')} AS std FROM flags"),
    "top_mismatch": ("pairs", f"""SELECT game_id, pa_seq, inning, half, base_state, score_diff_attacker, pa_result, runs_scored,
        {_r('reward_wpa')} AS reward_wpa, {_r('reward_wpa_computed')} AS reward_wpa_computed, {_r('abs_product')} AS abs_product
      FROM (SELECT *, abs(reward_wpa) * abs(reward_wpa_computed) AS abs_product FROM pairs WHERE reward_wpa <> 0
        AND reward_wpa_computed <> 0 AND sign(reward_wpa) <> sign(reward_wpa_computed))
      ORDER BY abs_product DESC, game_id, pa_seq LIMIT 10"""),
    "wpa_hist2d": ("pairs", """SELECT CAST(floor(reward_wpa / CAST(5 AS DOUBLE)) AS BIGINT) AS provider_cell,
        CAST(floor(reward_wpa_computed / CAST(0.05 AS DOUBLE)) AS BIGINT) AS reward_cell, count(*) AS n FROM pairs GROUP BY 1, 2"""),
    "wpa_verdict": ("judged_rows", f"SELECT number, criterion, threshold, {_r('value')} AS value, result, n_pass, conclusion FROM judged_rows"),
    "wpa_report": ("wpa pairs selfc signs lin rank flags judged_rows", f"""SELECT section, item, {_r('CAST(value AS DOUBLE)')} AS value FROM (
        SELECT 'figures' AS section, unnest(['missing', 'out_of_range', 'grand_mean', 'hr_mean', 'b1_mean', 'bb_mean', 'out_mean', 'domain_ok',
            'sign_match_rate', 'n_pairs', 'spearman', 'spearman_t', 'spearman_p', 'pearson', 'pearson_p']) AS item,
          unnest([CAST(missing AS DOUBLE), out_of_range, grand_mean, hr_mean, b1_mean, bb_mean, out_mean, CASE WHEN domain_ok THEN 1 ELSE 0 END,
            sign_match_rate, rank.n, rho, rank.t, rank.p, r, lin.p]) AS value FROM selfc, signs, rank, lin
        UNION ALL SELECT 'label_mean', pa_result, avg(reward_wpa_computed) FROM wpa GROUP BY pa_result
        UNION ALL SELECT 'label_n', pa_result, count(*) FROM wpa GROUP BY pa_result
        UNION ALL SELECT 'flag_std', flag, std FROM flags
        UNION ALL SELECT 'criterion', concat(criterion, ' ', threshold), value FROM judged_rows
        UNION ALL SELECT DISTINCT 'conclusion', conclusion, n_pass FROM judged_rows
        UNION ALL SELECT 'mismatch', item, x FROM (SELECT concat(game_id, '#', CAST(pa_seq AS VARCHAR)) AS item,
            abs(reward_wpa) * abs(reward_wpa_computed) AS x FROM pairs WHERE sign(reward_wpa) * sign(reward_wpa_computed) < 0
            ORDER BY x DESC, game_id, pa_seq LIMIT 10)
        UNION ALL SELECT 'season', substr(game_id, 1, 4), count(*) FROM pairs GROUP BY 2
        UNION ALL SELECT 'provider', unnest(['n', 'mean', 'std', 'min', 'q25', 'q50', 'q75', 'max']),
          unnest([CAST(n AS DOUBLE), mean, std, min, q25, q50, q75, max]) FROM ({_describe('', 'reward_wpa', 'pairs')})
        UNION ALL SELECT 'flag_n', flag, n FROM flags UNION ALL SELECT 'flag_mean', flag, mean FROM flags
        UNION ALL SELECT 'passed', criterion, CASE WHEN result = 'PASS' THEN 1 ELSE 0 END FROM judged_rows)"""),
    "widest_game": ("widest", "SELECT game_id, CAST(score_range AS INT) AS score_range FROM widest"),
    "game_head_tail": ("pa widest", """SELECT game_id, pa_seq, inning, home_or_away, out_count, base_state, score_diff, pa_result FROM (
        SELECT *, concat(CAST(is_base1 AS VARCHAR), CAST(is_base2 AS VARCHAR), CAST(is_base3 AS VARCHAR)) AS base_state,
          row_number() OVER (ORDER BY inning, home_or_away, out_count, pa_seq) AS rn, count(*) OVER () AS n
        FROM pa WHERE game_id = (SELECT game_id FROM widest)) WHERE rn <= 30 OR rn > n - 30"""),
    "convention_hypotheses": ("moves", """SELECT *, CASE WHEN h4 = 0 THEN 'H4' WHEN h3 = 0 THEN 'H3' WHEN h2 = 0 THEN 'H2' WHEN h1 = 0 THEN 'H1'
          ELSE 'UNKNOWN' END AS winner, least(h1, h2, h3, h4) AS fewest FROM (
        SELECT count(*) AS n_halves, count(*) FILTER (WHERE CASE WHEN home_or_away = 1 THEN any_down ELSE any_up END) AS h1,
          count(*) FILTER (WHERE any_down) AS h2, count(*) FILTER (WHERE CASE WHEN home_or_away = 1 THEN any_up ELSE any_down END) AS h3,
          count(*) FILTER (WHERE any_up) AS h4 FROM moves)"""),
    "violation_sample": ("pa moves", """SELECT game_id, inning, home_or_away, pa_seq, score_diff, pa_result FROM pa
        WHERE (game_id, inning, home_or_away) IN (SELECT (game_id, inning, home_or_away) FROM (SELECT * FROM moves WHERE any_down
          ORDER BY game_id, inning, home_or_away LIMIT 3))"""),
    "convention_first_inning": ("opening", "SELECT score_diff, count(*) AS n FROM opening GROUP BY score_diff"),
    "opening_nonzero": ("opening", "SELECT game_id, home_or_away, score_diff, pa_result FROM opening WHERE score_diff <> 0 ORDER BY game_id, home_or_away LIMIT 10"),
    "half_code_share": ("pa", _counts("home_or_away", "pa")),
    "half_order_check": ("pa", """SELECT count(*) FILTER (WHERE t IS NOT NULL AND b IS NOT NULL) AS n_both, count(*) FILTER (WHERE t < b) AS order_ok,
        count(*) FILTER (WHERE t >= b) AS order_fail FROM (SELECT min(pa_seq) FILTER (WHERE home_or_away = 0) AS t,
          min(pa_seq) FILTER (WHERE home_or_away = 1) AS b FROM pa GROUP BY game_id, inning)"""),
    "pa_result_dist": ("clean", _counts("pa_result", "clean")),
    "pa_result_counts": ("wpa", _counts("pa_result", "wpa")),
    "pitches_per_pa_all": ("wpa", _describe("", "pitches_per_pa", "wpa")),
    "unk_rate": ("pa", f"""SELECT n_pa, n_unknown, {_r('n_unknown / n_pa')} AS unknown_rate, n_unknown / n_pa > 0.05 AS alarm
        FROM (SELECT count(*) AS n_pa, count(*) FILTER (WHERE pa_result = 'UNK') AS n_unknown FROM pa)"""),
    "pitches_per_pa": ("clean", _describe("", "pitches_per_pa", "clean")),
    "pitch_count_hist": ("clean", _counts("pitches_per_pa", "clean")),
    "pitches_by_result": ("clean", f"SELECT pa_result, count(*) AS n, {_r('avg(pitches_per_pa)')} AS mean_pitches FROM clean GROUP BY pa_result"),
    "wpa_by_result_full": ("clean", _describe("pa_result", "reward_wpa_computed", "clean")),
    "runs_dist": ("clean", _counts("runs_scored", "clean")),
    "runs_by_result": ("clean", f"SELECT pa_result, count(*) AS n, {_r('avg(runs_scored)')} AS mean_runs FROM clean GROUP BY pa_result"),
    "situation_dist": ("clean", f"""SELECT dimension, value, count(*) AS n,
        {_r('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY dimension)')} AS pct
      FROM ({_long(SITUATIONS, 'clean')}) WHERE value IS NOT NULL GROUP BY dimension, value"""),
    "label_crosstab": ("clean", f"""SELECT pa_result, dimension, value, count(*) AS n,
        {_r('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY pa_result, dimension)')} AS row_pct
      FROM ({_long(CROSSED, 'clean', 'pa_result')}) WHERE value IS NOT NULL GROUP BY pa_result, dimension, value"""),
    "label_out_pivot": ("clean", "SELECT pa_result, " + ", ".join(
        f"{_r(f'count(*) FILTER (WHERE out_count = {n}) * 100.0 / count(*)')} AS pct_out{n}" for n in range(3)
    ) + " FROM clean GROUP BY pa_result"),
    "score_clip_dist": ("clean", _counts("greatest(-4, least(4, score_diff_attacker))", "clean", "score_clipped")),
    "score_summary": ("clean", f"""SELECT count(*) AS n, min(score_diff_attacker) AS min, max(score_diff_attacker) AS max,
        {_r('avg(score_diff_attacker)')} AS mean, {_r('stddev_samp(score_diff_attacker)')} AS std,
        count(*) FILTER (WHERE abs(score_diff_attacker) >= 4) AS n_abs4,
        {_r('count(*) FILTER (WHERE abs(score_diff_attacker) >= 4) * 100.0 / count(*)')} AS pct_abs4 FROM clean"""),
    "numeric_profile": ("clean", _describe("metric", "v", "(" + " UNION ALL ".join(
        f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS v FROM clean" for c in NUMERIC
    ) + ")")),
    "inning_end_rate": ("clean", f"""SELECT pa_result, n, n_ended, {_r('n_ended * 100.0 / n')} AS pct_ended FROM (
        SELECT coalesce(pa_result, 'ALL') AS pa_result, count(*) AS n, count(*) FILTER (WHERE inning_ended) AS n_ended
        FROM clean GROUP BY ROLLUP (pa_result))"""),
    "quality_summary": ("wpa", f"""SELECT *, {_r('n_clean * 100.0 / n_rows')} AS pct_clean, {_r('n_unknown * 100.0 / n_clean')} AS pct_unknown FROM (
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE ok) AS n_clean, count(*) FILTER (WHERE NOT ok) AS n_flagged,
          {', '.join(f"count(*) FILTER (WHERE ok AND {c} IS NULL) AS {c}_missing" for c in ('reward_wpa_computed', 'we_before', 'we_after', 'pitcher_vs_batter_avg', 'batter_recent_avg', 'pa_avg_pitch_speed'))},
          count(*) FILTER (WHERE ok AND pa_result = 'UNK') AS n_unknown, count(DISTINCT game_id) FILTER (WHERE ok) AS n_games,
          count(DISTINCT pitcher_id) FILTER (WHERE ok) AS n_pitchers, count(DISTINCT batter_id) FILTER (WHERE ok) AS n_batters
        FROM (SELECT *, data_quality_flag = '' AS ok FROM wpa))"""),
    "mean_var_utility": ("clean", f"""SELECT half, base_state, out_count, count(*) AS n, {_r('avg(reward_wpa_computed)')} AS mean_reward,
        {_r('var_samp(reward_wpa_computed)')} AS var_reward, {_r('avg(reward_wpa_computed) - 0.5 * var_samp(reward_wpa_computed)')} AS utility
      FROM clean GROUP BY half, base_state, out_count"""),
    "training_set": ("clean", f"""SELECT {FEATURE_ROWS}, {_r('coalesce(pitcher_vs_batter_avg, 0.25)')} AS pitcher_vs_batter_avg,
        {_r('coalesce(batter_recent_avg, 0.25)')} AS batter_recent_avg FROM clean"""),
    "training_set_regular": ("clean", f"""SELECT {FEATURE_ROWS}, {_r('pitcher_vs_batter_avg')} AS pitcher_vs_batter_avg,
        {_r('batter_recent_avg')} AS batter_recent_avg, coalesce(pa_avg_pitch_speed = 0, true) AS speed_missing,
        {_r('CASE WHEN coalesce(pa_avg_pitch_speed = 0, true) THEN 131.0 ELSE pa_avg_pitch_speed END')} AS pa_avg_pitch_speed
      FROM clean WHERE inning <= 9"""),
}


def oracle_sql() -> dict[str, str]:
    return {name: _sql(tables, body) for name, (tables, body) in BODIES.items()}
