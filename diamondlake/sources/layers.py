"""Files between the jobs: Parquet layers, CSV on request."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from diamondlake.functions.parsing import NA_WORDS
from diamondlake.functions.state import season_of
from diamondlake.operators.columns import order_columns
from diamondlake.schemas import PITCH, PITCH_COLUMNS
from diamondlake.sources.snapshots import current, read_rows

# Kinds of rows of the pitch layer.
PITCHES, REJECTS, DOCUMENTS = "pitches", "rejects", "documents"


def write_layer(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet by season.

    ``rebalance`` lets the adaptive planner cut a large season into even files
    and fold small ones together, so a season holding most rows stays parallel.
    """
    seasoned = df.withColumn("season", season_of(F.col("game_id")))
    seasoned.hint("rebalance", "season").write.mode(mode).partitionBy("season").parquet(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_pitch_layer(spark: SparkSession, path: str, kind: str = PITCHES) -> DataFrame:
    """Pitches, rejects or stored documents of the newest version of a pitch layer."""
    rows = read_rows(spark, current(spark, path))
    if rows is None:
        raise FileNotFoundError(f"no pitch layer at {path}")
    return rows.where(F.col("kind") == kind).drop("kind")


def write_csv(pitches: DataFrame, path: str) -> None:
    """Files with header lines, games in order, as many as the size of the data asks for.

    The adaptive planner packs small games into one file and cuts what is too large for one;
    the number of files does not depend on the number of games. ``csv_index`` tells where a game lies.
    """
    ordered = order_columns(pitches, PITCH_COLUMNS)
    keys = ["game_id", *[c for c in ("seq",) if c in pitches.columns]]
    ordered.hint("rebalance", "game_id").sortWithinPartitions(*keys).write.mode("overwrite").csv(path, header=True)


def typed_from_text(columns: dict[str, Column], schema: T.StructType) -> list[Column]:
    """Text columns -> declared types; the words for "missing" become NULL."""
    out = []
    for field in schema.fields:
        text = columns[field.name]
        known = F.when(~text.isin(NA_WORDS), text)
        value = known.try_cast(field.dataType)
        if isinstance(field.dataType, T.IntegerType | T.LongType):
            # A counter column with gaps comes back as '3.0'.
            value = F.coalesce(value, known.try_cast("double").try_cast(field.dataType))
        out.append(value.alias(field.name))
    return out


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, line): the first line of every CSV file below a folder; one row per file leaves a task."""
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    first = raw.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"), "value"
    )
    return first.groupBy("file").agg(F.min_by("value", "place").alias("line"))


def _names(line: str) -> list[str]:
    """Column names of a header line; a repeated or empty one gets a name no column has."""
    names = [name.strip() for name in next(csv.reader([line.removeprefix("\ufeff")]), [])]
    return [name if name and name not in names[:i] else f"\u0000{i}" for i, name in enumerate(names)]


def _by_header(spark: SparkSession, path: str) -> dict[str, tuple[list[str], list[str]]]:
    """Header line -> (column names, its files). Names of files and different headers come to the driver, no data."""
    groups = _headers(spark, path).groupBy("line").agg(F.collect_list("file").alias("files")).collect()
    return {g.line: (_names(g.line), [unquote(f) for f in g.files]) for g in groups}


def _scan(spark: SparkSession, names: list[str], files: list[str]) -> DataFrame:
    """Records of files of one header, by the header's names, with ``__place``: the order of rows in their file.

    The place is the start of the part a task reads plus the record's number in that task.
    A record has two characters at least, so parts stay in order.
    """
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    # Values as they stand: an empty one is the empty text, not NULL.
    rows = spark.read.schema(text).options(header=True, nullValue="\u0000", emptyValue="").csv(files)
    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return rows.withColumn("__place", F.col("_metadata.file_block_start") + number)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = PITCH) -> DataFrame:
    """All CSV files below a folder as one table.

    Files are grouped by their header and each group is scanned with its own columns, however
    many. Columns are found by name, in any order; a missing one is NULL, others are ignored, a
    byte-order mark too. ``seq``, where a file has none, is the place of the row in its file.
    Files whose header lacks ``game_id`` are left out here and listed by ``skipped_csv``.
    """
    groups = _by_header(spark, path)
    if not groups:
        raise FileNotFoundError(f"no CSV below {path}")
    parts = []
    for names, files in groups.values():
        if "game_id" not in names:
            continue
        columns = {f.name: F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast("string") for f in schema.fields}
        if "seq" in columns and "seq" not in names:
            columns["seq"] = F.col("__place").cast("string")
        parts.append(_scan(spark, names, files).select(*typed_from_text(columns, schema)))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def skipped_csv(spark: SparkSession, path: str) -> DataFrame:
    """(file, header) of the CSV files that ``read_csv`` leaves out."""
    rows = [(file, names) for names, files in _by_header(spark, path).values() if "game_id" not in names for file in files]
    return spark.createDataFrame(rows, "file string, header array<string>")


def csv_index(spark: SparkSession, path: str) -> DataFrame:
    """(game_id, file, n_rows): the files that hold a game."""
    parts = [_scan(spark, names, files).select("game_id", F.col("_metadata.file_path").alias("file"))
             for names, files in _by_header(spark, path).values() if "game_id" in names]
    return reduce(DataFrame.unionByName, parts).groupBy("game_id", "file").agg(F.count("*").alias("n_rows"))


def csv_round_trip(pitches: DataFrame, path: str, schema: T.StructType = PITCH) -> DataFrame:
    """Rows after being written to CSV files below ``path`` and read again."""
    write_csv(pitches.select(*schema.names), path)
    return read_csv(pitches.sparkSession, path, schema)
