"""MinHash near-duplicates from compressed registers (HyperMinHash).

A document's 5-word shingles are hashed into 128 buckets. Of the least hash of a
bucket only the number of leading zeros and ten mantissa bits are stored, sixteen bits
a register; an empty bucket borrows from a full one chosen by a fixed random order.
Bands of four registers propose pairs; the share of equal registers, corrected for
registers that agree by chance, estimates the Jaccard similarity; what the estimate
does not rule out is confirmed on the full shingle sets.

Groups of copies: equal sets are one class from the start. In a band's bucket the
classes meet in blocks of bounded size. Each block first proposes only a spanning
forest of its best pairs; once those are confirmed and joined, only classes that are
still in another component than the bucket's largest one meet all the others, so a
large group costs as much as its stragglers, and no link between components is lost.

Defined results: a text without words, or NULL, has an empty set and links with
nothing; a text of fewer than five words is one shingle; a row without id links with
nothing and is kept; an id that occurs twice is judged per row, each text by itself; texts of
any length are hashed whole; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.byte_words import mix, shingle_sets
from diamondlake.llm.components import components, spanning_forest
from diamondlake.llm.text_units import text_slices
from diamondlake.operators.materialize import materialize

REGISTERS, BANDS = 128, 32
MANTISSA = 10
BLOCK = 256
#: Characters hashed at once, about 100 times as much memory.
HASHED_CHARS = 300_000
_ATTEMPTS = 512
#: Bits of the filter of wanted texts, 4 MB.
FILTER_BITS = 1 << 25


# ---- sketches ------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _lenders() -> np.ndarray:
    """For every bucket, the buckets it may borrow from, in a fixed random order."""
    seeds = np.arange(_ATTEMPTS * REGISTERS, dtype=np.uint64).reshape(_ATTEMPTS, REGISTERS)
    return (mix(seeds + np.uint64(1)) % np.uint64(REGISTERS)).astype(np.int64)


def compress(least: np.ndarray) -> np.ndarray:
    """57-bit minima -> leading zeros and mantissa bits in sixteen bits."""
    width = 57
    value = least.astype(np.uint64)
    bits = np.zeros(value.shape, dtype=np.int64)
    rest = value.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1 << step)
        bits += np.where(big, step, 0)
        rest = np.where(big, rest >> np.uint64(step), rest)
    # bits: place of the highest set bit; the mantissa follows it.
    shift = bits - MANTISSA
    mantissa = np.where(shift >= 0, value >> np.maximum(shift, 0).astype(np.uint64), value << np.maximum(-shift, 0).astype(np.uint64))
    zeros = np.minimum(width - 1 - bits, 63)
    return (zeros.astype(np.uint16) << MANTISSA) | (mantissa.astype(np.uint16) & ((1 << MANTISSA) - 1))


def registers(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers of every set; rows of empty sets are zero."""
    n = len(bounds) - 1
    empty = np.uint64((1 << 64) - 1)
    least = np.full(n * REGISTERS, empty, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    hashed = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    np.minimum.at(least, owner * REGISTERS + (hashed & np.uint64(REGISTERS - 1)).astype(np.int64), hashed >> np.uint64(7))
    least = least.reshape(n, REGISTERS)
    full = least != empty
    out = np.where(full, compress(np.where(full, least, np.uint64(0))), np.uint16(0)).astype(np.uint16)
    rows = np.flatnonzero(full.any(1) & ~full.all(1))
    missing = ~full[rows]
    for source in _lenders():
        if not len(rows):
            break
        lend = missing & full[rows][:, source]
        out[rows] = np.where(lend, out[rows][:, source], out[rows])
        missing &= ~lend
        open_ = missing.any(1)
        rows, missing = rows[open_], missing[open_]
    for row, gaps in zip(rows, missing):  # hardly ever: the next full bucket lends
        have = np.flatnonzero(full[row])
        gap = np.flatnonzero(gaps)
        out[row, gap] = out[row, have[np.searchsorted(have, gap) % len(have)]]
    return out


def key_of(text: str) -> int:
    """What tells texts of one id apart: bytes and crc32."""
    raw = text.encode()
    return (len(raw) & 0x7FFFFFFF) << 32 | zlib.crc32(raw)


def text_key(text: Column) -> Column:
    """``key_of`` as a column; a NULL text is an empty one."""
    text = F.coalesce(text, F.lit("")).cast("binary")
    return F.shiftleft(F.octet_length(text).cast("long").bitwiseAND(0x7FFFFFFF), 32).bitwiseOR(F.crc32(text))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, n, set_hash, registers) of every row; set_hash is NULL for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_slices(batches, HASHED_CHARS):
            shingles, bounds = shingle_sets(texts)
            n = np.diff(bounds)
            # Two sums over the set, 128 bits together, stand for the set.
            sums = [np.concatenate(([np.uint64(0)], np.cumsum(mix(shingles + np.uint64(k)), dtype=np.uint64))) for k in (11, 23)]
            first, second = ((s[bounds[1:]] - s[bounds[:-1]]).astype("<u8") for s in sums)
            pairs = np.stack([first, second], axis=1)
            packed = registers(shingles, bounds)
            yield pa.record_batch({
                "id": pa.array(ids, pa.int64()), "text_key": pa.array([key_of(t) for t in texts], pa.int64()), "n": pa.array(n, pa.int64()),
                "set_hash": pa.array([pairs[i].tobytes() if n[i] else None for i in range(len(n))], pa.binary()),
                "registers": pa.array([r.tobytes() for r in packed], pa.binary()),
            })

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(run, "id long, text_key long, n long, set_hash binary, registers binary")


# ---- estimates -------------------------------------------------------------------------


@lru_cache(maxsize=100_000)
def _chance(log_a: int, log_b: int) -> float:
    """Probability that a register of two disjoint sets agrees; sizes as quarter powers of two."""
    per = [max(1.0, 2 ** (x / 4) / REGISTERS) for x in (log_a, log_b)]
    edges = np.concatenate([[0.0], *[2.0 ** (-z - 1) * (1 + np.arange(64) / 64) for z in range(40, -1, -1)], [1.0]])
    # Within 1/64 of a power of two the density is even; each step holds 2**MANTISSA / 64 registers.
    mass = [np.diff(-np.exp(p * np.log1p(-np.minimum(edges, 1 - 1e-12)))) for p in per]
    return float((mass[0] * mass[1]).sum() / (2**MANTISSA / 64))


def estimate(regs: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less chance agreement."""
    equal = (regs[left] == regs[right]).mean(axis=1)
    logs = np.round(4 * np.log2(np.maximum(size, 1))).astype(int)
    chance = np.array([_chance(int(a), int(b)) for a, b in zip(logs[left], logs[right])]) if len(left) else np.zeros(0)
    return (equal - chance) / (1 - chance)


def least_estimate(size: np.ndarray, threshold: float) -> np.ndarray:
    """What an estimate must reach: four standard deviations below the threshold.

    Registers sample the union, so small sets add the spread of uneven lending.
    """
    spread = np.sqrt(threshold * (1 - threshold) * (1 / REGISTERS + 2 / np.maximum(size, 1)))
    return threshold - 4 * spread


def candidate_pairs(ids, size, regs, component, band, home, visitor, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, estimate) of the pairs of a block that may be links and are not yet joined.

    A pair counts in the first band in which it agrees, so each pair comes from one bucket.
    """
    left, right = np.nonzero(
        home[:, None] & visitor[None] & (component[:, None] != component[None])
        & ((ids[:, None] < ids[None]) | ~(home[None] & visitor[:, None]))
        & (np.minimum(size[:, None], size[None]) >= threshold * np.maximum(size[:, None], size[None]))
    )
    bands = np.ascontiguousarray(regs).view(np.uint64)
    keep = (bands[left, band] == bands[right, band])
    if band:
        keep &= ~(bands[left, :band] == bands[right, :band]).any(axis=1)
    left, right = left[keep], right[keep]
    found = estimate(regs, size, left, right)
    keep = found >= least_estimate(np.maximum(size[left], size[right]), threshold)
    return left[keep], right[keep], found[keep]


# ---- pairs ---------------------------------------------------------------------------------

_PAIR = "a long, b long"


def _pair_table(a, b) -> pa.Table:
    a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    regs = np.frombuffer(b"".join(rows["registers"].to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
    return rows["id"].to_numpy(), rows["n"].to_numpy(), regs


def forest_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Per block of a bucket, the spanning forest of its best pairs."""

    def run(rows: pa.Table) -> pa.Table:
        ids, size, regs = _columns(rows)
        every = np.ones(len(ids), dtype=bool)
        left, right, found = candidate_pairs(ids, size, regs, ids, rows["band"][0].as_py(), every, every, threshold)
        order = np.argsort(-found, kind="stable")
        left, right = left[order], right[order]
        keep = spanning_forest(left, right)
        return _pair_table(ids[left[keep]], ids[right[keep]])

    # Other blocks in every band, so the parts of a large group meet in some band.
    block = F.pmod(F.xxhash64("id", "band"), F.ceil(F.col("in_bucket") / BLOCK))
    return members.withColumn("block", block).groupBy("key", "block").applyInArrow(run, _PAIR).distinct()


def _maybe_in(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without most of those whose keys are not in ``wanted``, so that the others need not move to a join.

    Bits of hashed keys, ``FILTER_BITS`` at most whatever the input; more keys let more rows through, never fewer.
    """
    at = (F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS)) + 1).alias("at")
    bits = wanted.select(at).groupBy(F.bitmap_bucket_number("at").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__bits"))
    tested = rows.withColumn("__at", at).withColumn("__bucket", F.bitmap_bucket_number("__at")).join(F.broadcast(materialize(bits)), "__bucket")
    byte = F.conv(F.hex(F.expr("substring(__bits, int(bitmap_bit_position(__at) / 8) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("int(bitmap_bit_position(__at) % 8)")
    return tested.where(F.getbit(byte, hit) == 1).select(*rows.columns)


def set_rows(texts: DataFrame) -> DataFrame:
    """(id, shingles): the full shingle set of every (id, text) row, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts_ in text_slices(batches, HASHED_CHARS):
            shingles, bounds = shingle_sets(texts_)
            sets = [shingles[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.record_batch({"id": pa.array(ids, pa.int64()), "shingles": pa.array(sets, pa.binary())})

    return texts.select("id", "text").mapInArrow(run, "id long, shingles binary")


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int = 16_384) -> np.ndarray:
    """Sizes of the intersections of many pairs of sets of one block.

    Few pairs are intersected one by one; many by products of membership matrices
    over slices of the block's shingles.
    """
    if len(left) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right)], dtype=np.int64)
    value, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    # A shingle of a single set adds nothing.
    common = np.bincount(column)[column] > 1
    row, column = row[common], np.unique(column[common], return_inverse=True)[1]
    total = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for at in range(0, int(column.max(initial=-1)) + 1, columns):
        low, high = np.searchsorted(column, (at, at + columns))
        part = np.zeros((len(sets), columns), dtype=np.float32)
        part[row[low:high], column[low:high] - at] = 1
        total += (part @ part.T).astype(np.int64)
    return total[left, right]


def straggler_links(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Confirmed links between components within a bucket. ``members`` has ``component``.

    Members outside the bucket's largest component visit all blocks of the bucket, first
    with their registers; those in a pair that is left open meet again with their full
    sets, so only links leave a block: a spanning forest of them.
    """
    per = members.groupBy("key", "component").agg(F.count("*").alias("k"))
    per = per.groupBy("key").agg(F.max_by("component", F.struct("k", "component")).alias("largest"), F.sum("k").alias("all"), F.max("k").alias("k"))
    per = materialize(per.where(F.col("k") < F.col("all")).select("key", "largest", "all", (F.col("all") - F.col("k")).alias("outside")))
    rows = members.join(per, "key")
    blocks, chunks = F.ceil(F.col("all") / BLOCK), F.ceil(F.col("outside") / BLOCK)
    at = F.xxhash64("id", "band")
    home = rows.withColumns({
        "home": F.lit(True), "block": F.pmod(at, blocks), "chunk": F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))})
    away = rows.where(F.col("component") != F.col("largest")).withColumns({
        "home": F.lit(False), "block": F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)), "chunk": F.pmod(at, chunks)})
    percent = round(100 * threshold)

    def open_pairs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, size, regs = _columns(rows)
        home = rows["home"].to_numpy(zero_copy_only=False)
        component = rows["component"].to_numpy()
        outside = component != rows["largest"].to_numpy()
        left, right, _ = candidate_pairs(ids, size, regs, component, rows["band"][0].as_py(), home, ~home, threshold)
        # A pair of stragglers meets twice, once in the home block of each.
        keep = ~outside[left] | (ids[left] < ids[right])
        return left[keep], right[keep]

    def in_pairs(rows: pa.Table) -> pa.Table:
        return rows.take(pa.array(np.unique(np.concatenate(open_pairs(rows)))))

    def run(rows: pa.Table) -> pa.Table:
        left, right = open_pairs(rows)
        ids, size, component = (rows[c].to_numpy() for c in ("id", "n", "component"))
        sets = [np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"].to_pylist()]
        both = intersections(sets, left, right)
        keep = (both > 0) & (100 * both >= percent * (size[left] + size[right] - both))
        left, right = left[keep], right[keep]
        keep = spanning_forest(component[left], component[right])
        return _pair_table(ids[left[keep]], ids[right[keep]])

    place = ["key", "block", "chunk"]
    met = home.unionByName(away).select("id", "n", "registers", "band", "component", "largest", "home", *place)
    # Most rows of a block are in no pair that the registers leave open; only the others need their sets.
    met = materialize(met.groupBy(*place).applyInArrow(in_pairs, met.schema))
    sets = set_rows(texts.join(met.select("id").distinct(), "id", "left_semi"))
    return met.join(sets, "id").groupBy(*place).applyInArrow(run, _PAIR)


def confirmed(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold. ``texts``: (id, text), one row per id."""
    percent = round(100 * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = np.zeros(len(a), dtype=bool)
            # As many pairs at once as fit into a slice of bounded size, one at least.
            size = np.cumsum(pc.add(pc.utf8_length(batch.column(2)), pc.utf8_length(batch.column(3))).to_numpy())
            at = 0
            while at < len(a):
                upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + HASHED_CHARS, side="right")))
                left, right = (batch.column(c).slice(at, upto - at).to_pylist() for c in (2, 3))
                place = {t: i for i, t in enumerate(dict.fromkeys(left + right))}
                shingles, bounds = shingle_sets(list(place))
                sets = [shingles[s:e] for s, e in zip(bounds, bounds[1:])]
                for k, (x, y) in enumerate(zip(left, right), at):
                    x, y = sets[place[x]], sets[place[y]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[k] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
                at = upto
            yield pa.record_batch({"a": a[keep], "b": b[keep]})

    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(run, _PAIR)


# ---- operator --------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_key (see ``text_key``), n_shingles, component_id, kept.

    Documents are linked at a Jaccard similarity of ``threshold`` (two decimals) or
    more; component_id is the smallest id reachable by links.
    """
    every = materialize(sketches(docs, id_col, text_col))
    with_set = every.where(F.col("id").isNotNull() & F.col("set_hash").isNotNull())
    # One class per set, numbered when it is written; it stands for itself by its smallest document.
    least = F.min(F.struct(F.col("id").alias("doc"), "text_key", "n", "registers")).alias("r")
    classes = with_set.groupBy("set_hash").agg(least).select("set_hash", "r.*")
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()))
    band = F.posexplode(F.array(*[F.xxhash64(F.lit(b), F.substring("registers", 8 * b + 1, 8)) for b in range(BANDS)])).alias("band", "key")
    banded = classes.select("id", band)
    shared = materialize(banded.groupBy("key").agg(F.count("*").alias("in_bucket")).where(F.col("in_bucket") > 1))
    in_buckets = banded.join(shared, "key")
    members = materialize(in_buckets.join(classes.select("id", "n", "registers"), "id"))
    # Only texts of classes that share a bucket are needed from here on.
    wanted = materialize(members.select("id").distinct().join(classes.select("id", "doc", "text_key"), "id"))
    source = docs.select(F.col(id_col).cast("long").alias("doc"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    texts = _maybe_in(source, wanted, ["doc", "text_key"]).join(wanted, ["doc", "text_key"])
    texts = materialize(texts.groupBy("id").agg(F.min("text").alias("text")))

    best = materialize(forest_pairs(members, threshold))
    links = materialize(confirmed(best, texts, threshold))
    joined = materialize(components(links))
    component = F.coalesce("component", F.col("id")).alias("component")
    current = materialize(members.join(joined, "id", "left").select(*members.columns, component))
    final = components(links.union(straggler_links(current, texts, threshold)))

    of_class = classes.join(final, "id", "left").select("set_hash", "doc", F.coalesce("component", F.col("id")).alias("component"))
    smallest = of_class.groupBy("component").agg(F.min("doc").alias("component_id"))
    of_class = of_class.join(smallest, "component").select("set_hash", "component_id")
    result = every.select("id", "text_key", "n", "set_hash").join(materialize(of_class), "set_hash", "left")
    alone = F.col("set_hash").isNull() | F.col("id").isNull()
    result = result.select(
        F.col("id").alias(id_col), "text_key", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
