"""The pitch layer is the same in whatever order, and in however many runs, its documents land."""

import glob
import json

import pytest
from compare import bag
from pyspark.sql import functions as F

from diamondlake.operators.materialize import materialize, shared_folder, tables
from diamondlake.operators.reward import checked
from diamondlake.plans import jobs, relay_view
from diamondlake.schemas import PITCH, RELAY_DOCUMENT
from diamondlake.sources import layers, relay, snapshots
from diamondlake.streaming import incremental

OPTION = {"type": 1, "pitchResult": "S", "currentGameState": {"pitcher": "1", "batter": "2"}}


def payload(inning, n=2):
    listed = [{"homeOrAway": "0", "inn": inning, "textOptions": [OPTION] * n}]
    return json.dumps({"result": {"textRelayData": {"textRelays": listed}}})


def frame(spark, rows):
    return spark.createDataFrame(rows, RELAY_DOCUMENT)


def contents(spark, path):
    pitches = layers.read_pitch_layer(spark, path).select(*PITCH.names)
    rejects = layers.read_pitch_layer(spark, path, layers.REJECTS).select("game_id", "req_inning", "reason", "seq")
    return bag(pitches.columns, pitches.collect()), bag(rejects.columns, rejects.collect())


EMPTY = '{"result":{}}'
GAMES = ("20240401HHSK02024", "20240402HHSK02024", "20230401HHSK02023", "g", None)
LANDED = [(g, n, payload(n)) for g in GAMES for n in range(1, 6)]
LATE = {
    "late innings": [(g, n, payload(n)) for g in (GAMES[0], None) for n in (6, 7)],
    "landed again": [(GAMES[0], 2, payload(2, 5)), (None, 3, payload(3, 1))],
    "unreadable, then good": [(GAMES[1], 6, payload(6)), (GAMES[1], 7, payload(7))],
    "an end before known innings": [(GAMES[2], 3, EMPTY + " "), (GAMES[2], 9, payload(9))],
    "a new game": [("20240501HHSK02024", 1, payload(1))],
    "no inning": [(GAMES[0], None, payload(1)), (None, None, None)],
}


@pytest.mark.parametrize("cases", [tuple(LATE)[:3], tuple(LATE)[3:]])
def test_later_documents(spark, tmp_path, cases):
    first = [*LANDED, (GAMES[1], 6, payload(6)[:30]), (GAMES[1], 7, None)]
    later = [row for case in cases for row in LATE[case]]
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    jobs.collect_pitches(frame(spark, [*first, *later]), one, buckets=2)
    jobs.collect_pitches(frame(spark, first), two, buckets=2)
    # All that has landed, then only what is new.
    jobs.collect_pitches(frame(spark, [*first, *later]), two, buckets=2)
    version = snapshots.current(spark, two).version
    assert version == 2
    jobs.collect_pitches(frame(spark, later), two, buckets=2)
    assert snapshots.current(spark, two).version == version
    assert contents(spark, one) == contents(spark, two)


def test_innings_one_by_one(spark, small, tmp_path):
    """Many versions: few folders in use, nothing lost, old ones gone; a failed version does not count."""
    documents = relay_view.relay_documents(spark, small)
    games = [r.game_id for r in documents.select("game_id").distinct().orderBy("game_id").limit(3).collect()]
    documents = documents.where(F.col("game_id").isin(games)).cache()
    out = str(tmp_path / "out")
    for batch in range(9):
        part = documents.where(F.col("req_inning") == batch + 1)
        incremental.store_batch(part, batch, out, buckets=1, most=3)
        if batch == 5:
            # A run that stopped before its manifest was written.
            layers.read_pitch_layer(spark, f"{out}/rows").limit(3).write.parquet(f"{out}/rows/v=99")
    incremental.store_batch(documents.where("req_inning > 9"), 9, out, buckets=1, most=3)
    now = snapshots.current(spark, f"{out}/rows")
    assert len(now.folders) <= 3 * len(now.parts())
    assert len(glob.glob(f"{out}/rows/v=*/season=*")) < 10
    want, got = relay.parse_pitches(documents), incremental.read_pitches(spark, out)
    assert bag(want.columns, want.collect()) == bag(got.columns, got.collect())


def test_raw_files(spark, tmp_path):
    """The job and the stream read one payload per file."""
    landed = tmp_path / "landed"
    landed.mkdir()
    for n in range(1, 4):
        (landed / f"20240401HHSK02024_{n}.json").write_text(payload(n))
    (landed / "notes.json").write_text("{}")
    made = jobs.run(spark, str(landed), str(tmp_path / "run"), raw_files=True)
    assert layers.read_pitch_layer(spark, made.path("pitches")).count() == 6
    (landed / "20240401HHSK02024_4.json").write_text(payload(4))
    jobs.run(spark, str(landed), str(tmp_path / "run"), raw_files=True)
    assert layers.read_pitch_layer(spark, made.path("pitches")).count() == 8
    incremental.start_pitch_stream(spark, str(landed), str(tmp_path / "out"), str(tmp_path / "check"), 2, raw_files=True).awaitTermination()
    assert incremental.read_pitches(spark, str(tmp_path / "out")).count() == 8


def test_no_documents(spark, tmp_path):
    assert jobs.collect_pitches(frame(spark, []), str(tmp_path / "none")).version == 0
    with pytest.raises(FileNotFoundError):
        layers.read_pitch_layer(spark, str(tmp_path / "none"))


def test_check_while_writing(spark, tmp_path):
    rows = spark.createDataFrame([(0.5,), (2.0,), (None,)], "reward_wpa_computed double")
    observed, verdict = checked(rows)
    observed.write.parquet(str(tmp_path / "rows"))
    with pytest.raises(ValueError):
        verdict()
    observed, verdict = checked(rows.where("reward_wpa_computed IS NOT NULL"))
    observed.write.parquet(str(tmp_path / "good"))
    assert verdict() == 1


def test_tables_of_a_scope_go(spark):
    def count():
        return len(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/tables/*"))

    before = count()
    with tables(spark):
        outer = materialize(spark.range(3))
        with tables(spark):
            materialize(spark.range(4))
            assert count() == before + 2
        assert count() == before + 1 and outer.count() == 3
    assert count() == before
