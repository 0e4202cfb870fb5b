"""The chunked plans give the rows of the plain ones when every game counts as large."""

import pytest
from compare import bag

from diamondlake.operators import conventions, ordered, transitions
from diamondlake.operators.ordered import Order, by_size, deal, find_hot, key_minimum, neighbour, position, rolling_mean, running
from diamondlake.operators.plate_appearances import add_pitch_counts, add_recent_speed, aggregate_pa, assign_pa
from diamondlake.plans import pitch_view as view
from diamondlake.plans import queries, relay_view
from diamondlake.sources import relay
from pyspark.sql import functions as F

WIDTH = 7


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    one, two = bag(a.columns, a.collect()), bag(b.columns, b.collect())
    assert one == two and sum(one.values()) > 0


@pytest.fixture(scope="module")
def pitches(spark, small):
    return view.pitch_view(spark, small).cache()


@pytest.fixture(scope="module")
def hot(pitches):
    return find_hot(pitches, "game_id", 250)


def test_find_hot(pitches, hot):
    sizes = {r.game_id: r["count"] for r in pitches.groupBy("game_id").count().collect()}
    assert {r.game_id for r in hot.collect()} == {g for g, n in sizes.items() if n > 250}
    assert 0 < hot.count() < len(sizes)
    assert find_hot(pitches, "game_id", 10**6) is None


def test_pitch_view(spark, small, pitches):
    same(view.pitch_view(spark, small, limit=250, width=WIDTH), pitches)


def split(rows, hot, run, width=WIDTH):
    return by_size(rows, hot, "game_id", width, run)


def test_pa_seq(pitches, hot):
    same(split(pitches, hot, assign_pa), assign_pa(pitches))


def test_pitch_counts(pitches, hot):
    same(split(pitches, hot, lambda rows, w: add_pitch_counts(rows, width=w)), add_pitch_counts(pitches))


def test_recent_speed(pitches, hot):
    same(split(pitches, hot, lambda rows, w: add_recent_speed(rows, width=w)), add_recent_speed(pitches))


def test_transitions(pitches, hot):
    pa = aggregate_pa(add_pitch_counts(assign_pa(pitches))).cache()
    same(split(pa, hot, lambda rows, w: transitions.link_transitions(rows, width=w), 3), transitions.link_transitions(pa))
    same(split(pa, hot, conventions.half_moves, 3), conventions.half_moves(pa))


def test_whole_chain(spark, small, pitches, monkeypatch):
    """Some games plain, some in chunks, from the scan to the reward."""
    plain = queries.rewards(spark, small)
    branches = view.pitch_branches(spark, small, 250, WIDTH)
    assert [w for _, w in branches] == [None, WIDTH]
    monkeypatch.setattr(view, "pitch_branches", lambda *_: branches)
    same(queries.rewards(spark, small), plain)


def test_rows_of_a_task(spark, small, monkeypatch):
    """The rows that a task sorts do not grow with the input, and no side of the join is broadcast."""
    monkeypatch.setattr(ordered, "TASK_ROWS", 250)
    n = spark.read.parquet(f"{small}/lineitem.parquet").count()
    (rows, width), = view.pitch_branches(spark, small)
    per = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p"), "game_id").count().groupBy("p").count().collect()]
    assert width is None and sum(per) > 15 and max(per) <= 6
    assert deal(spark.range(5), n, "id").rdd.getNumPartitions() == -(-n // 250) > 8
    assert deal(spark.range(5), 0, "id").rdd.getNumPartitions() == 8
    assert "BroadcastHashJoin" not in queries.training_set(spark, small)._jdf.queryExecution().executedPlan().toString()


def test_relay_documents(spark, small):
    documents = relay_view.relay_documents(spark, small).cache()
    same(relay.parse_pitches(documents, 2 * relay.SEQ_STEP), relay.parse_pitches(documents))


@pytest.fixture(scope="module")
def series(spark):
    rows = [(k, i, (i * 7919 + k) % 23, None if i % 4 == k else float(i % 11)) for k in range(3) for i in range(0, 60 * (k + 1), 2)]
    rows += [(None, i, i % 5, 1.5 * i) for i in range(20)]
    return spark.createDataFrame(rows, "k int, i long, v int, s double").cache()


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_primitives(series, width):
    plain, split = Order(("k",), ("i",)), Order(("k",), ("i",), width)
    for kind in ("sum", "max"):
        same(running(series, "out", F.col("v"), split, kind), running(series, "out", F.col("v"), plain, kind))
    same(position(series, "out", split), position(series, "out", plain))
    for step in (-1, 1):
        same(neighbour(series, {"a": "v", "b": "s"}, split, step), neighbour(series, {"a": "v", "b": "s"}, plain, step))
    same(rolling_mean(series, "out", "s", split, 5), rolling_mean(series, "out", "s", plain, 5))


def test_key_minimum(series):
    known = series.where("k is not null")
    same(key_minimum(known, "out", F.col("v"), ["k"], 3), key_minimum(known, "out", F.col("v"), ["k"]))
