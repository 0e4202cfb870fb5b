"""Importance resampling towards a target corpus by hashed n-gram gains.

1. Every batch interns its n-grams in an open-addressed NumPy table: the slot of a feature
   is found from its xxhash64 by linear probing, and a slot counts as the feature's own only
   if the bytes agree. A slot stores the feature's bucket and its count.
2. Bucket counts of source and target (``buckets`` numbers a task at most, added up in Spark)
   give one gain per bucket; this array of fixed length is all that goes to the tasks.
3. A second pass interns again; the slot ids of the occurrences gather the slots' gains, and
   a document's weight is the floored mean over its occurrences.
4. Weight plus Gumbel noise from the id is the score. Scores are whole numbers of a few ten
   thousand different values, so a histogram tells which scores are drawn; ranks are counted
   inside a score and moved by the number of rows above it. Noise of different ids spreads:
   less than 0.04 % of them share a score.

Defined results: a NULL or empty text has no features and weight 0; without target or source
features gains follow from the smoothing alone; a NULL id has no noise, hence NULL score, and
is neither counted nor drawn; equal rows are drawn one by one, in any order; texts of any
length are read whole, a longer one than a slice in a slice of its own; an empty table gives
no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.llm.text_units import text_slices
from diamondlake.operators.materialize import materialize

SLICE_CHARS = 2_000_000
#: Bytes of words: A-Z lower-cased, digits, a-z and everything from 0x80 on; the rest separates.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

# The five primes of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _rotate(acc + lane * _P2, 31) * _P1


class Lanes:
    """Unaligned 8-byte, 4-byte and single loads from one byte array."""

    def __init__(self, data: bytes):
        padded = data + bytes(8)
        self.eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        self.four = np.ndarray(len(data) + 1, "<u4", padded, strides=(1,))
        self.one = np.frombuffer(padded, dtype=np.uint8)


def xxhash64(lanes: Lanes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of many byte ranges at once."""
    at, left = start.copy(), size.copy()
    h = np.full(len(start), _P5)
    with np.errstate(over="ignore"):
        long = np.flatnonzero(size >= 32)
        if len(long):
            acc = [np.full(len(long), v) for v in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
            live = np.arange(len(long))
            while len(live):
                row = long[live]
                for k in range(4):
                    acc[k][live] = _round(acc[k][live], lanes.eight[at[row] + 8 * k])
                at[row] += 32
                left[row] -= 32
                live = live[left[row] >= 32]
            mixed = _rotate(acc[0], 1) + _rotate(acc[1], 7) + _rotate(acc[2], 12) + _rotate(acc[3], 18)
            for k in range(4):
                mixed = (mixed ^ _round(np.uint64(0), acc[k])) * _P1 + _P4
            h[long] = mixed
        h += size.astype(np.uint64)
        for width, loads in ((8, lanes.eight), (4, lanes.four), (1, lanes.one)):
            live = np.flatnonzero(left >= width)
            while len(live):
                lane = loads[at[live]].astype(np.uint64)
                if width == 8:
                    h[live] = _rotate(h[live] ^ _round(np.uint64(0), lane), 27) * _P1 + _P4
                elif width == 4:
                    h[live] = _rotate(h[live] ^ (lane * _P1), 23) * _P2 + _P3
                else:
                    h[live] = _rotate(h[live] ^ (lane * _P5), 11) * _P1
                at[live] += width
                left[live] -= width
                live = live[left[live] >= width]
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def same_bytes(lanes: Lanes, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ranges of ``size`` bytes at x and y agree."""
    same = np.ones(len(x), dtype=bool)
    live, done = np.arange(len(x)), 0
    while len(live):
        rest = size[live] - done
        differ = lanes.eight[x[live] + done] ^ lanes.eight[y[live] + done]
        # Of the last load only the bytes inside the range count.
        short = rest < 8
        differ[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
        same[live[differ != 0]] = False
        done += 8
        live = live[(differ == 0) & (rest > 8)]
    return same


@dataclass
class Features:
    """Occurrences of n-grams in the joined, folded words of a slice of texts."""

    data: bytes
    start: np.ndarray
    size: np.ndarray
    text: np.ndarray
    n_words: np.ndarray


def features(texts: list[str], longest: int) -> Features:
    """All runs of 1 to ``longest`` consecutive words of every text, joined by one space."""
    split = [t.encode().translate(_FOLD).split() for t in texts]
    n_words = np.array([len(s) for s in split], dtype=np.int64)
    words = [w for s in split for w in s]
    length = np.array([len(w) for w in words], dtype=np.int64)
    stop = np.cumsum(length + 1) - 1
    begin = stop - length
    text = np.repeat(np.arange(len(texts)), n_words)
    starts, sizes, owners = [], [], []
    for n in range(1, min(longest, len(words)) + 1):
        inside = text[: len(words) - n + 1] == text[n - 1 :]
        first = np.flatnonzero(inside)
        starts.append(begin[first])
        sizes.append(stop[first + n - 1] - begin[first])
        owners.append(text[first])
    empty = [np.zeros(0, dtype=np.int64)]
    start, size, owner = (np.concatenate(parts or empty) for parts in (starts, sizes, owners))
    return Features(b" ".join(words), start, size, owner, n_words)


class SlotTable:
    """Open addressing over the features of one slice."""

    def __init__(self, found: Features, buckets: int):
        lanes, n = Lanes(found.data), len(found.start)
        self.capacity = 1 << max(4, (2 * n).bit_length())
        mask = np.uint64(self.capacity - 1)
        key = xxhash64(lanes, found.start, found.size)
        owner = np.full(self.capacity, -1, dtype=np.int64)
        place = (key & mask).astype(np.int64)
        #: Slot of every occurrence.
        self.slot = np.empty(n, dtype=np.int64)
        waiting = np.arange(n)
        while len(waiting):
            at = place[waiting]
            free = owner[at] < 0
            # Of several that claim a free slot one gets it; the others look at what is there now.
            owner[at[free]] = waiting[free]
            mine = owner[at]
            same = (key[mine] == key[waiting]) & (found.size[mine] == found.size[waiting])
            check = np.flatnonzero(same)
            same[check] = same_bytes(lanes, found.start[mine[check]], found.start[waiting[check]], found.size[waiting[check]])
            self.slot[waiting[same]] = at[same]
            waiting = waiting[~same]
            place[waiting] = (place[waiting] + 1) & int(mask)
        self.used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.slot, minlength=self.capacity)
        self.bucket = np.zeros(self.capacity, dtype=np.int64)
        data, first = found.data, owner[self.used]
        self.bucket[self.used] = [
            zlib.crc32(data[a : a + b]) % buckets for a, b in zip(found.start[first].tolist(), found.size[first].tolist())
        ]

    def bucket_counts(self, buckets: int) -> np.ndarray:
        return np.bincount(self.bucket[self.used], weights=self.count[self.used], minlength=buckets).astype(np.int64)


def bucket_counts(texts: DataFrame, text_col: str, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) over all features of a text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, part in text_slices(batches, SLICE_CHARS):
            total += SlotTable(features(part, longest), buckets).bucket_counts(buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch({"bucket": some, "n": total[some]})

    counted = texts.select(F.lit(0), F.col(text_col)).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) by bucket; at most ``buckets`` rows come to the driver."""
    counts = []
    for frame in (source, target):
        one = np.zeros(buckets)
        for row in frame.collect():
            one[row["bucket"]] = row["n"]
        counts.append(one)
    s, t = counts
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, part in text_slices(batches, SLICE_CHARS):
            found = features(part, longest)
            table = SlotTable(found, len(gain))
            slot_gain = gain[table.bucket]
            count = np.bincount(found.text, minlength=len(part))
            total = np.bincount(found.text, weights=slot_gain[table.slot], minlength=len(part)).astype(np.int64)
            yield pa.record_batch({"id": pa.array(ids, pa.int64()), "n_words": found.n_words, "n_features": count.astype(np.int64),
                                   "weight": total // np.maximum(count, 1)})

    weighed = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "id long, n_words long, n_features long, weight long")
    return weighed.withColumnRenamed("id", id_col)


def gumbel(seed: int, key: Column) -> Column:
    """floor(-1000 ln(-ln(u))) of a number u in (0, 1) that the key fixes."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(u)))


def resample(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, share: int = 10, least_words: int = 20,
    seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """Every document with n_features, weight, score and, for the drawn ``share`` per cent, its rank.

    Documents of fewer than ``least_words`` words are scored but not drawn.
    """
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    scored = weigh(docs, gain, longest, id_col, text_col)
    scored = materialize(scored.withColumn("score", F.col("weight") + gumbel(seed, F.col(id_col))))
    eligible = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    by_score = scored.where(eligible).groupBy("score").agg(F.count("*").alias("rows"))
    # One row per different score, at most some ten thousand.
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    above = by_score.select("score", F.coalesce(F.sum("rows").over(down), F.lit(0)).alias("above"), F.sum("rows").over(Window.partitionBy()).alias("all"))
    drawn = F.floor(F.col("all") * share / 100)
    reached = above.where(F.col("above") < drawn).select(F.col("score").alias("__score"), "above", drawn.alias("drawn"))
    marked = scored.join(reached, eligible & (F.col("score") == F.col("__score")), "left")
    columns = [id_col, "n_features", "weight", "score"]
    inside = Window.partitionBy("score").orderBy(id_col)
    ranked = marked.where("above IS NOT NULL").withColumn("rank", F.col("above") + F.row_number().over(inside))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")))
    others = marked.where("above IS NULL").withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns, "rank").unionByName(others.select(*columns, "rank"))
