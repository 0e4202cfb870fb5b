"""A table that is replaced in parts: folders of rows, and a manifest that says which of them count.

Rows lie below ``v=<version>/season=<s>/bucket=<b>``; a bucket is a hash of the game. A version
adds folders and may take the place of older ones: the manifest of a version lists, per season
and bucket, the versions whose folders hold its rows. A manifest is one small file and is
written last, so a version is there as a whole or not at all, and a run that failed before
leaves nothing that counts; the next one writes over it. One writer at a time.

``most`` folders of one season and bucket are merged when one more would come, so a reader
opens at most seasons x buckets x ``most`` folders, however many versions there were.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diamondlake.functions.state import season_of
from diamondlake.operators.materialize import remove

BUCKETS, MOST = 16, 4
MANIFEST = "version long, season string, bucket int, folder long"
# Where games lie whose id does not begin with a year.
OTHER = "other"


@dataclass(frozen=True)
class Snapshot:
    """Which folders hold the rows of a table; ``version`` 0 is the empty table."""

    path: str
    version: int = 0
    folders: frozenset[tuple[str, int, int]] = frozenset()
    buckets: int = BUCKETS

    def paths(self, parts: set[tuple[str, int]] | None = None) -> list[str]:
        """Folders of all parts (season, bucket), or of some."""
        return sorted(f"{self.path}/v={v}/season={s}/bucket={b}" for s, b, v in self.folders if parts is None or (s, b) in parts)

    def parts(self) -> set[tuple[str, int]]:
        return {(s, b) for s, b, _ in self.folders}


def part_columns(buckets: int) -> dict[str, Column]:
    """Season and bucket of a row."""
    season = season_of(F.col("game_id"))
    return {
        "season": F.when(season.rlike("^[0-9]{4}$"), season).otherwise(OTHER),
        "bucket": F.pmod(F.xxhash64("game_id"), F.lit(buckets)).cast("int"),
    }


def _manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{path}/_manifest/versions")


def current(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Snapshot:
    """The newest version that was finished; a table keeps the number of buckets it began with."""
    try:
        rows = _manifests(spark, path)
        newest = rows.agg(F.max("version")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None:
        return Snapshot(path, buckets=buckets)
    listed = rows.where(F.col("version") == newest).collect()  # one row per folder in use
    head = next(r for r in listed if r.season is None)
    return Snapshot(path, newest, frozenset((r.season, r.bucket, r.folder) for r in listed if r.season is not None), head.bucket)


def read_rows(spark: SparkSession, snapshot: Snapshot, parts: set[tuple[str, int]] | None = None) -> DataFrame | None:
    """Rows of a version; None for none."""
    paths = snapshot.paths(parts)
    if not paths:
        return None
    return spark.read.option("basePath", snapshot.path).parquet(*paths).drop("v", "bucket")


def crowded(snapshot: Snapshot, parts: set[tuple[str, int]], most: int = MOST) -> set[tuple[str, int]]:
    """Those of the parts that have no room for one more folder."""
    count: dict[tuple[str, int], int] = {}
    for s, b, _ in snapshot.folders:
        count[s, b] = count.get((s, b), 0) + 1
    return {part for part in parts if count.get(part, 0) >= most}


def commit(rows: DataFrame, snapshot: Snapshot, added: set[tuple[str, int]], replaced: set[tuple[str, int]], by: str) -> Snapshot:
    """Write ``rows`` as the next version. They lie in the parts ``added``; of ``replaced`` parts nothing older counts.

    ``by`` is the column that divides a part's folder further.
    """
    spark, version = rows.sparkSession, snapshot.version + 1
    placed = rows.drop("season", "bucket").withColumns(part_columns(snapshot.buckets))
    placed.hint("rebalance", by, "season", "bucket").write.mode("overwrite").partitionBy("season", "bucket", by).parquet(f"{snapshot.path}/v={version}")
    kept = {(s, b, v) for s, b, v in snapshot.folders if (s, b) not in replaced}
    made = replace(snapshot, version=version, folders=frozenset(kept | {(s, b, version) for s, b in added | replaced}))
    listed = [(version, None, made.buckets, None), *((version, *f) for f in sorted(made.folders))]
    spark.createDataFrame(listed, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{snapshot.path}/_manifest/versions/{version:012d}")
    return made


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove what only manifests older than the newest ``keep`` refer to; the versions whose folders went.

    Readers of one of the kept versions are not disturbed.
    """
    rows = _manifests(spark, path)
    versions = sorted((r[0] for r in rows.select("version").distinct().collect()), reverse=True)
    used = {r[0] for r in rows.where(F.col("version").isin(versions[:keep])).select("folder").distinct().collect()}
    gone = [v for v in range(1, max(versions) + 1) if v not in used and v not in versions[:keep]]
    for v in gone:
        remove(spark, f"{path}/v={v}")
        remove(spark, f"{path}/_manifest/versions/{v:012d}")
    return gone
