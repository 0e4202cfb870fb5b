"""The chained jobs, each from layer to layer.

    documents -> pitches -> plate appearances -> states -> rewards -> report

Every job reads the layer before it, asks once which games are too large for a
single task, and writes its own layer, from which a failed later job restarts.

The pitch layer keeps the documents it was made from. A run compares what has landed with
them and parses anew, from all its documents, every game that has one the layer does not
know: a late inning, one that landed again, one that was unreadable before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diamondlake.operators.features import training_set
from diamondlake.operators.materialize import materialize, move, tables
from diamondlake.operators.ordered import CHUNK_WIDTH, HOT_LIMIT, by_size, find_hot
from diamondlake.operators.plate_appearances import plate_appearances
from diamondlake.operators.reward import add_reward, checked
from diamondlake.operators.transitions import transitions
from diamondlake.operators.validation import report
from diamondlake.schemas import PITCH
from diamondlake.sources.layers import DOCUMENTS, PITCHES, REJECTS, read_layer, read_pitch_layer, write_layer
from diamondlake.sources.relay import (
    SEQ_WIDTH, cut_after_end, distinct_documents, finish_pitches, latest_documents, pitches_of, raw_pitches, read_relay_documents,
    read_relay_folder, rejects_of, semi,
)
from diamondlake.sources.schedule import only_listed
from diamondlake.sources.snapshots import BUCKETS, MOST, Snapshot, commit, crowded, current, part_columns, read_rows, vacuum

# The shortest pitch: {"type":1,"pitchResult":""}
PITCH_CHARS = 27


@dataclass(frozen=True)
class Layers:
    """Folders of one run."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def _hot_games(rows: DataFrame, limit: int) -> DataFrame | None:
    return find_hot(rows.select("game_id"), "game_id", limit)


def hot_documents(documents: DataFrame, limit: int = HOT_LIMIT) -> DataFrame | None:
    """Games that may have more than ``limit`` pitches, told from the size of their documents.

    A pitch takes at least PITCH_CHARS characters of JSON, so no game with more
    than ``limit`` pitches is missed.
    """
    sizes = documents.groupBy("game_id").agg(F.sum(F.length("payload")).alias("size"))
    hot = materialize(sizes.where(F.col("size") > limit * PITCH_CHARS).select("game_id"))
    return None if hot.isEmpty() else hot


def collect_pitches(
    documents: DataFrame, path: str, ids: DataFrame | None = None, limit: int = HOT_LIMIT, buckets: int = BUCKETS, most: int = MOST
) -> Snapshot:
    """Documents -> pitch layer with its rejects and the documents themselves, in one commit. Only listed games.

    Games with a document that the layer does not know are parsed from all they have, old and
    new, and take the place of what was there; so the layer is the same in whatever order, and
    in however many runs, the documents land. Without such a game nothing is written.
    """
    spark = documents.sparkSession
    with tables(spark):
        before = current(spark, path, buckets)
        stored = read_rows(spark, before)
        wanted = documents if ids is None else only_listed(documents, ids)
        landed = distinct_documents(wanted)
        if stored is None:
            touched, known, replaced = None, materialize(landed), set()
        else:
            key = ["game_id", "req_inning", "digest"]
            old = stored.where(F.col("kind") == DOCUMENTS)
            unknown = materialize(semi(landed, old.select(*key), "left_anti"))
            touched = materialize(unknown.select("game_id").distinct())
            old = semi(old, touched)
            replaced = _parts(old, before.buckets)
            known = materialize(unknown.unionByName(old.select(*unknown.columns)))
        if known.isEmpty():
            return before
        added = _parts(known, before.buckets)
        replaced |= crowded(before, added, most)
        rows = parsed(latest_documents(known), limit).unionByName(known.withColumn("kind", F.lit(DOCUMENTS)), allowMissingColumns=True)
        if replaced:
            # What else lies in the parts that are written anew.
            others = semi(read_rows(spark, before, replaced), touched, "left_anti")
            rows = rows.unionByName(others, allowMissingColumns=True)
        return commit(rows, before, added, replaced, "kind")


def _parts(rows: DataFrame, buckets: int) -> set[tuple[str, int]]:
    """Seasons and buckets in which rows lie."""
    return {(r.season, r.bucket) for r in rows.select(*[c.alias(n) for n, c in part_columns(buckets).items()]).distinct().collect()}


def parsed(documents: DataFrame, limit: int = HOT_LIMIT) -> DataFrame:
    """Pitches and rejects of documents as one table, told apart by ``kind``."""

    def both(rows: DataFrame, width: int | None) -> DataFrame:
        kept = cut_after_end(raw_pitches(rows), width)
        pitches = finish_pitches(pitches_of(kept), width).withColumn("kind", F.lit(PITCHES))
        rejects = rejects_of(kept).withColumn("kind", F.lit(REJECTS))
        return pitches.unionByName(rejects, allowMissingColumns=True)

    return by_size(documents, hot_documents(documents, limit), "game_id", SEQ_WIDTH, both)


def build_plate_appearances(spark: SparkSession, layers: Layers, limit: int = HOT_LIMIT) -> None:
    pitches = read_pitch_layer(spark, layers.path(PITCHES)).select(*PITCH.names)
    hot = _hot_games(pitches, limit)
    write_layer(by_size(pitches, hot, "game_id", SEQ_WIDTH, plate_appearances), layers.path("plate_appearances"))


def build_states(spark: SparkSession, layers: Layers, limit: int = HOT_LIMIT) -> None:
    pa = read_layer(spark, layers.path("plate_appearances")).drop("season")
    hot = _hot_games(pa, limit)
    write_layer(by_size(pa, hot, "game_id", CHUNK_WIDTH, lambda rows, w: transitions(rows, width=w)), layers.path("states"))


def build_rewards(spark: SparkSession, layers: Layers) -> int:
    """Write the reward layer; return how many rewards lie outside [-1, 1].

    The checks are counted while the rows are written, beside the layer; only rows that pass take its place.
    """
    rewards, verdict = checked(add_reward(read_layer(spark, layers.path("states")).drop("season")))
    write_layer(rewards, layers.path("rewards.new"))
    outside = verdict()
    move(spark, layers.path("rewards.new"), layers.path("rewards"))
    return outside


def validate(spark: SparkSession, layers: Layers) -> None:
    rewards = read_layer(spark, layers.path("rewards"))
    report(rewards).write.mode("overwrite").json(layers.path("report"))


def build_training_set(spark: SparkSession, layers: Layers, **options) -> None:
    rewards = read_layer(spark, layers.path("rewards")).drop("season")
    write_layer(training_set(rewards, **options), layers.path("training_set"))


def run(
    spark: SparkSession, documents_path: str, root: str, ids: DataFrame | None = None, limit: int = HOT_LIMIT, raw_files: bool = False
) -> Layers:
    """All jobs in order over landed documents: JSON lines, or with ``raw_files`` one payload per ``<game_id>_<inning>.json``.

    Only games that have documents the pitch layer does not know are parsed.
    """
    layers = Layers(root)
    documents = (read_relay_folder if raw_files else read_relay_documents)(spark, documents_path)
    collect_pitches(documents, layers.path(PITCHES), ids, limit)
    with tables(spark):
        build_plate_appearances(spark, layers, limit)
        build_states(spark, layers, limit)
        build_rewards(spark, layers)
        validate(spark, layers)
        build_training_set(spark, layers)
    vacuum(spark, layers.path(PITCHES))
    return layers
