"""Relay documents -> relays -> options -> pitch rows.

The payload is parsed to VARIANT and read once, with one nested type. A field
stays VARIANT in that type where more than its value matters: whether the key is
there at all, whether it holds JSON null, or whether it is number or text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diamondlake.functions.parsing import (
    base_flag, hit_side, na_to_null, nullable_number, safe_number, score_difference, variant_truthy,
)
from diamondlake.operators.columns import order_columns
from diamondlake.operators.ordered import key_minimum
from diamondlake.operators.plate_appearances import add_pitch_counts, add_recent_speed
from diamondlake.schemas import PITCH, PITCH_COLUMNS, RELAY_DOCUMENT

# Event kinds in a relay.
BATTER_EVENT, PITCH_EVENT, RESULT_EVENTS = "8", "1", ("13", "23")
LAST_INNING = 12
# Places of halves in an inning that the sequence number has room for, one of them unused.
HALVES = 256
INNING_FAULT, PAYLOAD_FAULT = "inning", "payload"
RELAYS_PATH = "$.result.textRelayData.textRelays"
# Chunk of a large game in units of ``seq`` (see sequence_number): 8,192 relays of a half.
SEQ_STEP = 1 << 20
SEQ_WIDTH = 8192 * SEQ_STEP

RECORD_TYPE = "struct<todayHra: variant, seasonHra: string, vsHra: string, hitType: string>"
STATE_TYPE = (
    "struct<pitcher: variant, batter: variant, homeScore: string, awayScore: string, out: variant, ball: variant,"
    " strike: variant, base1: string, base2: string, base3: string>"
)
OPTION_TYPE = (
    "struct<type: variant, text: string, speed: string, stuff: string, pitchResult: variant,"
    f" batterRecord: {RECORD_TYPE}, currentGameState: {STATE_TYPE}>"
)
RELAY_TYPE = (
    "struct<homeOrAway: variant, inn: variant, metricOption: struct<wpaByPlate: double>,"
    f" textOptions: array<{OPTION_TYPE}>>"
)


def read_relay_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents, one JSON object per line: game_id, req_inning, payload text."""
    return spark.read.schema(RELAY_DOCUMENT).json(path)


def from_raw_files(files: DataFrame) -> DataFrame:
    """Whole files with their names, ``<game_id>_<inning>.json``, as documents; other names are left out."""
    pattern = r"^(.+)_(\d+)\.json$"
    return files.where(F.col("name").rlike(pattern)).select(
        F.regexp_extract("name", pattern, 1).alias("game_id"),
        F.regexp_extract("name", pattern, 2).try_cast("int").alias("req_inning"),
        F.col("value").alias("payload"),
    )


def read_relay_folder(spark: SparkSession, path: str) -> DataFrame:
    """Landed raw payload files named ``<game_id>_<inning>.json``, one payload per file."""
    return from_raw_files(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("name")))


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _kind(option: Column) -> Column:
    """Event kind as JSON text, so that a kind written as text is none of the known ones."""
    return F.to_json(option["type"])


def _or_default(value: Column, known: Column, default: Column) -> Column:
    """The default only for an absent key; JSON null is a value of its own."""
    return F.when(value.isNull(), default).otherwise(known)


def _code_text(relay: Column, default: Column) -> Column:
    code = relay["homeOrAway"]
    return _or_default(code, F.coalesce(_text(code), F.lit("None")), default)


def relays(documents: DataFrame, last_inning: int = LAST_INNING) -> DataFrame:
    """One row per relay with its place and its half's rank among the document's half codes.

    A document without relays keeps one empty row. ``fault`` tells why a document is
    set aside: its inning is none of 1 to ``last_inning``, or its payload is no JSON.
    """
    known = F.coalesce(F.col("req_inning").between(1, last_inning), F.lit(False))
    parsed = documents.select("game_id", "req_inning", F.when(known, F.try_parse_json("payload")).alias("json"))
    parsed = parsed.select(
        "game_id", "req_inning",
        F.when(~known, INNING_FAULT).when(F.col("json").isNull(), PAYLOAD_FAULT).alias("fault"),
        F.try_variant_get("json", RELAYS_PATH, f"array<{RELAY_TYPE}>").alias("list"),
    )
    codes = F.array_sort(F.array_distinct(F.transform("list", lambda r: _code_text(r, F.lit("0")))))
    rows = parsed.select("*", codes.alias("codes")).select(
        "game_id", "req_inning", "fault", "codes", F.posexplode_outer("list").alias("relay_pos", "relay")
    )
    half = F.array_position("codes", _code_text(F.col("relay"), F.lit("0")))
    return rows.withColumn("half_rank", half).drop("codes")


def stop_inning() -> Column:
    """An inning past the first that came empty; the game ends before the least of them.

    An inning that could not be read is not an empty one.
    """
    empty = F.col("relay").isNull() & F.col("fault").isNull() & (F.col("req_inning") > 1)
    return F.when(empty, F.col("req_inning"))


def cut_after_end(rows: DataFrame, width: int | None = None) -> DataFrame:
    """Drop the first empty inning past inning 1 and every later one."""
    marked = key_minimum(rows, "__stop", F.col("stop"), ["game_id"], width)
    kept = marked.where(F.col("__stop").isNull() | F.col("fault").isNotNull() | (F.col("req_inning") < F.col("__stop")))
    return kept.drop("__stop")


def kept_innings(documents: DataFrame) -> DataFrame:
    """(game_id, req_inning, n_relays) of the documents that are processed."""
    sizes = relays(documents).withColumn("stop", stop_inning()).groupBy("game_id", "req_inning", "fault").agg(
        F.count("relay").alias("n_relays"), F.min("stop").alias("stop")
    )
    return cut_after_end(sizes).where(F.col("fault").isNull()).drop("stop", "fault")


def options(documents: DataFrame) -> DataFrame:
    """One row per option of a relay, with both places."""
    found = relays(documents).where(F.col("relay").isNotNull())
    return found.select(
        "game_id", "req_inning", "relay_pos", F.posexplode("relay.textOptions").alias("opt_pos", "option")
    ).withColumn("kind", _kind(F.col("option")))


def sequence_number() -> Column:
    """Order of a pitch in its game, packed into one integer.

    Requested inning, then half by its code's full text, then relays newest first,
    then options as delivered. No sort or counter over the game is needed. A
    document whose places do not fit is an error, never a wrong order.
    """
    step = F.lit(SEQ_STEP).cast("bigint")
    fits = (F.col("relay_pos") < step) & (F.col("opt_pos") < step) & (F.col("half_rank") < HALVES)
    half = F.col("req_inning").cast("bigint") * HALVES + F.col("half_rank")
    packed = (half * step + (step - 1 - F.col("relay_pos"))) * step + F.col("opt_pos")
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("a relay document has too many halves, relays or options")).cast("bigint"))


def raw_pitches(documents: DataFrame) -> DataFrame:
    """Pitch rows before counters, plus one marker row per empty or unreadable document (``seq`` NULL)."""
    inn = F.col("relay.inn")
    listed = F.col("relay.textOptions")
    batter = F.get(F.filter(listed, lambda o: _kind(o) == BATTER_EVENT), F.lit(0))
    result = F.get(F.filter(listed, lambda o: _kind(o).isin(*RESULT_EVENTS)), F.lit(0))
    # Only pitches are exploded; places are kept from the full list.
    numbered = F.transform(listed, lambda o, i: F.struct(i.alias("opt_pos"), o.alias("option")))
    thrown = F.filter(
        numbered, lambda e: e["option"]["pitchResult"].isNotNull() & (_kind(e["option"]) == PITCH_EVENT)
    )
    # Relay fields first, so that they are computed once and no relay is copied per pitch.
    found = relays(documents).select(
        "game_id", "req_inning", "fault", "relay_pos", "half_rank", stop_inning().alias("stop"),
        _code_text(F.col("relay"), F.lit("0")).alias("code_text"),
        _or_default(inn, F.try_variant_get(inn, "$", "int"), F.col("req_inning")).alias("inning"),
        F.col("relay.metricOption.wpaByPlate").alias("reward_wpa"),
        batter["batterRecord"].alias("record"),
        F.coalesce(result["text"], F.lit("")).alias("relay_text"),
        thrown.alias("thrown"),
    )
    today = F.col("record.todayHra")
    recent = F.when(variant_truthy(today), _text(today)).otherwise(F.col("record.seasonHra"))
    # Also once per relay: numbers in text are the dearest part of a pitch row.
    fields = found.select(
        "game_id", "req_inning", "fault", "relay_pos", "half_rank", "stop", "inning", "reward_wpa", "thrown",
        F.col("code_text").try_cast("int").alias("home_or_away"),
        hit_side(F.col("record.hitType")).alias("batter_hit_type"),
        safe_number(F.col("record.vsHra")).alias("pitcher_vs_batter_avg"),
        safe_number(recent).alias("batter_recent_avg"),
        na_to_null(F.col("relay_text")).alias("relay_text"),
    )
    events = fields.select(*[c for c in fields.columns if c != "thrown"], F.explode_outer("thrown").alias("event"))
    events = events.where(F.col("event").isNotNull() | F.col("stop").isNotNull() | F.col("fault").isNotNull())
    events = events.withColumns({"opt_pos": F.col("event.opt_pos"), "option": F.col("event.option")})

    def count_of(name: str) -> Column:
        value = F.col(f"option.currentGameState.{name}")
        return _or_default(value, F.try_variant_get(value, "$", "int"), F.lit(0))

    def id_of(name: str) -> Column:
        value = F.col(f"option.currentGameState.{name}")
        return _or_default(value, F.coalesce(_text(value), F.lit("None")), F.lit(""))

    state = "option.currentGameState"
    return events.select(
        "game_id", "req_inning", "fault", "stop", "inning", "home_or_away",
        score_difference(F.col(f"{state}.homeScore"), F.col(f"{state}.awayScore")).alias("score_diff"),
        count_of("out").alias("out_count"),
        count_of("ball").alias("ball_count_B"),
        count_of("strike").alias("ball_count_S"),
        *[base_flag(F.col(f"{state}.base{n}")).alias(f"is_base{n}") for n in (1, 2, 3)],
        id_of("pitcher").alias("pitcher_text"),
        id_of("batter").alias("batter_text"),
        "batter_hit_type", "pitcher_vs_batter_avg", "batter_recent_avg",
        nullable_number(F.col("option.speed")).alias("pitch_speed"),
        na_to_null(F.col("option.stuff")).alias("pitch_type"),
        na_to_null(_text(F.col("option.pitchResult"))).alias("pitch_result"),
        "relay_text", "reward_wpa",
        F.when(F.col("opt_pos").isNotNull(), sequence_number()).alias("seq"),
    )


def pitch_rows(documents: DataFrame, width: int | None = None) -> DataFrame:
    """Parsed pitches of all kept innings with pitcher and batter still as text."""
    return pitches_of(cut_after_end(raw_pitches(documents), width))


def pitches_of(kept: DataFrame) -> DataFrame:
    """The pitches among kept rows, without the markers of documents."""
    return kept.where(F.col("seq").isNotNull()).drop("stop", "req_inning", "fault")


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Pitches whose inning cannot be read; they are set aside, not dropped with their game."""
    return rows.where(F.col("inning").isNull())


def rejects_of(kept: DataFrame) -> DataFrame:
    """Everything set aside: such pitches, and documents with a fault (one row each)."""
    reason = F.coalesce("fault", F.when(F.col("seq").isNotNull() & F.col("inning").isNull(), F.lit(INNING_FAULT)))
    return kept.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("stop", "fault")


def with_digest(documents: DataFrame) -> DataFrame:
    """Documents with a digest of the payload, by which a document is known again; NULL for none."""
    return documents.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))


def _same(left: list[str], prefix: str) -> Column:
    """Equality of key columns in which NULL equals NULL."""
    same = F.lit(True)
    for name in left:
        same = same & F.col(name).eqNullSafe(F.col(f"{prefix}{name}"))
    return same


def semi(rows: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose values of the columns of ``keys`` are (or, with left_anti, are not) among them, NULLs included."""
    named = keys.select(*[F.col(c).alias(f"__{c}") for c in keys.columns])
    return rows.join(named, _same(keys.columns, "__"), how)


def latest_documents(documents: DataFrame) -> DataFrame:
    """One document per game and inning: the readable one, then the longest, then the largest text.

    Only the documents of innings that came more than once are compared.
    """
    key = ["game_id", "req_inning"]
    twice = documents.groupBy(*key).count().where(F.col("count") > 1).select(*key)
    readable = F.try_parse_json("payload").isNotNull()
    best = semi(documents, twice).groupBy(*key).agg(
        F.max(F.struct(readable.alias("readable"), F.length("payload").alias("size"), "payload"))["payload"].alias("payload")
    )
    return semi(documents, twice, "left_anti").select(*key, "payload").unionByName(best.select(*key, "payload"))


def distinct_documents(documents: DataFrame) -> DataFrame:
    """Each different document once, with its digest. Only those that came more than once move."""
    key = ["game_id", "req_inning", "digest"]
    known = with_digest(documents.select("game_id", "req_inning", "payload"))
    twice = known.groupBy(*key).count().where(F.col("count") > 1).select(*key)
    return semi(known, twice, "left_anti").unionByName(semi(known, twice).dropDuplicates(key))


def parse_pitches(documents: DataFrame, width: int | None = None) -> DataFrame:
    """Relay documents -> the 23-column pitch table plus ``seq``.

    Counters run on the id text, where an unknown pitcher is a group like any
    other; only then do the words for "missing" become NULL.
    """
    return finish_pitches(pitch_rows(documents, width), width)


def finish_pitches(rows: DataFrame, width: int | None = None) -> DataFrame:
    """Counters, typed ids and column order for parsed rows; unreadable innings are left out."""
    counted = add_pitch_counts(rows.where(F.col("inning").isNotNull()), "pitcher_text", width)
    counted = add_recent_speed(counted, "pitcher_text", width)
    ids = {f"{who}_id": na_to_null(F.col(f"{who}_text")).try_cast("bigint") for who in ("pitcher", "batter")}
    table = order_columns(counted.withColumns(ids).drop("pitcher_text", "batter_text"), PITCH_COLUMNS)
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PITCH.fields])
