"""Removal of long repeated passages by a hash-compared suffix sort.

A byte goes when it is covered by a string of ``length`` bytes that also starts
anywhere else in the corpus. Strings of that length are found in three steps.

1. Anchors. Of the ``gram``-byte strings in a window of ``length`` bytes the one with the
   least hash is the window's anchor, so equal windows have equal anchors at the same
   place. A run of windows with one anchor is a context. About one byte in 150 is an
   anchor; only the hashes of anchor and context travel.
2. Anchors that occur once cannot belong to a repeated string. Contexts of repeated
   anchors that all look alike are repeated as a whole. What decides there is the 64-bit
   hash of the whole context among contexts of one anchor hash; no suffix is sorted and no
   byte compared for them.
3. Where contexts of one anchor differ, one copy of each different context is fetched
   and the suffixes that start in it are sorted: mergesort, whose comparisons find the
   common extension of two suffixes by binary search over prefix polynomial hashes.
   Neighbours that agree over ``length`` bytes are compared byte by byte.

An anchor with more than ``CHUNK`` different contexts is sorted in chunks; what a chunk
leaves open is matched across chunks by a 128-bit digest of the window.

Repeated runs of a number of words, however few bytes they have, are found beside that by the
same anchors over the hashes of words; where contexts differ, digests of their windows decide.

Defined results: a NULL text is empty; texts shorter than ``length`` bytes lose nothing;
equal rows (same id and text) count as two places; offsets are bytes of the UTF-8 text; texts
of any length are read in overlapping pieces, so every window is seen; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.arrow_groups import changes, whole_groups
from diamondlake.llm.byte_words import PrefixHashes, mix, word_hashes
from diamondlake.llm.text_units import text_slices
from diamondlake.operators.materialize import materialize, settled

CHUNK = 8_192
#: Bytes handled at once, about 150 times as much memory; positions in a piece need 24 bits.
PIECE = 300_000
#: Words of an anchor where runs of words are looked for.
WORD_GRAM = 12
_PLACE = np.uint64((1 << 24) - 1)
_WORD = re.compile(rb"\S+")


# ---- anchors ------------------------------------------------------------------------------


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Contexts of joined texts: text, first and last window start, anchor, hashes of anchor and context."""
    grams = len(data) - gram + 1
    width = length - gram + 1
    windows = grams - width + 1
    if windows <= 0:
        return {name: np.zeros(0, dtype=np.int64) for name in ("text", "low", "high", "anchor", "g", "e")}
    hashes = PrefixHashes(data)
    at = np.arange(grams)
    g = mix(hashes.of(at, at + gram))
    key = (g & ~_PLACE) | at.astype(np.uint64)
    # Sliding minimum: minima from block starts and to block ends.
    blocks = np.concatenate([key, np.full(-grams % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    start = np.arange(windows)
    text = np.searchsorted(ends, start, side="right")
    inside = start + length <= ends[text]
    start, text, anchor = start[inside], text[inside], (least[inside] & _PLACE).astype(np.int64)
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    if not len(first):
        return {name: np.zeros(0, dtype=np.int64) for name in ("text", "low", "high", "anchor", "g", "e")}
    low, high = start[first], start[np.append(first[1:] - 1, len(start) - 1)]
    return {"text": text[first], "low": low, "high": high, "anchor": anchor[first],
            "g": g[anchor[first]], "e": mix(hashes.of(low, high + length) + np.uint64(1))}


def _packed_place(low: np.ndarray, high: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """First window start, number of further starts, and the anchor's distance, in one integer."""
    return (low << 32) | ((high - low) << 16) | (anchor - low)


_LOW, _SPAN, _TO_ANCHOR = "shiftright(place, 32)", "(shiftright(place, 16) & 65535)", "(place & 65535)"


def context_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, place, g, e) of every context of (k1, k2, text) rows."""

    def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
        """Texts in pieces of bounded size; a longer text in overlapping parts."""
        who, raw, offset, size = [], [], [], 0
        for i, text in enumerate(texts):
            whole = text.encode()
            # The parts share length - 1 bytes, so every window lies in exactly one.
            for at in range(0, max(1, len(whole)), PIECE - length + 1):
                part = whole[at : at + PIECE]
                if at and len(part) < length:
                    continue
                if who and size + len(part) > PIECE:
                    yield who, raw, offset
                    who, raw, offset, size = [], [], [], 0
                who.append(i)
                raw.append(part)
                offset.append(at)
                size += len(part)
        if who:
            yield who, raw, offset

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            places = pa.RecordBatch.from_arrays([pa.array(np.arange(len(k1))), batch.column(2)], names=["i", "text"])
            for rows, texts in text_slices(iter([places]), PIECE):
                rows = np.array(rows)
                for who, raw, offset in pieces(texts):
                    found = anchors(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([len(r) for r in raw]), length, gram)
                    begin = np.cumsum([0, *map(len, raw[:-1])])[found["text"]] - np.array(offset)[found["text"]]
                    row = rows[np.array(who)[found["text"]]]
                    place = _packed_place(found["low"] - begin, found["high"] - begin, found["anchor"] - begin)
                    e = found["e"].astype(np.int64)
                    yield pa.record_batch({"k1": k1[row], "k2": k2[row], "place": place, "g": found["g"].astype(np.int64), "e": e})

    return docs.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 int, place long, g long, e long")


# ---- suffix sort -----------------------------------------------------------------------------


class HashedSuffixes:
    """Comparison of suffixes of one byte array, up to ``length`` bytes, by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.hashes = data, length, PrefixHashes(data)

    def agree(self, x: np.ndarray, y: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return self.hashes.of(x, x + n) == self.hashes.of(y, y + n)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common beginning, by binary search."""
        low, high = np.zeros(len(x), dtype=np.int64), np.full(len(x), self.length, dtype=np.int64)
        for _ in range(self.length.bit_length()):
            middle = (low + high + 1) >> 1
            same = self.agree(x, y, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=bool)
        open_ = np.flatnonzero(~self.agree(x, y, self.length))
        if len(open_):
            x, y = x[open_], y[open_]
            n = self.extension(x, y)
            out[open_] = self.data[np.minimum(x + n, len(self.data) - 1)] < self.data[np.minimum(y + n, len(self.data) - 1)]
        return out

    def sort(self, start: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Order of the suffixes at ``start`` within their buckets (ascending integers).

        Bottom-up mergesort of all buckets at once: every suffix finds its rank in
        the neighbouring run by binary search.
        """
        order = np.argsort(bucket, kind="stable")
        sizes = np.unique(bucket, return_counts=True)[1]
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        end = begin + np.repeat(sizes, sizes)
        place = np.arange(len(order))
        width = 1
        while width < sizes.max(initial=0):
            left = begin + (place - begin) // (2 * width) * (2 * width)
            middle = np.minimum(left + width, end)
            right = np.minimum(left + 2 * width, end)
            live = np.flatnonzero(middle < right)
            first = place[live] < middle[live]
            own = np.where(first, left[live], middle[live])
            low = np.where(first, middle[live], left[live])
            high = np.where(first, right[live], middle[live])
            base = low.copy()
            x = start[order[live]]
            search = np.arange(len(live))
            while len(search):
                at = (low[search] + high[search]) >> 1
                y = start[order[at]]
                # Equal suffixes of the left run come first.
                swap = first[search]
                smaller = self.less(np.where(swap, y, x[search]), np.where(swap, x[search], y))
                up = smaller == swap
                low[search] = np.where(up, at + 1, low[search])
                high[search] = np.where(up, high[search], at)
                search = search[low[search] < high[search]]
            moved = order.copy()
            moved[left[live] + (live - own) + (low - base)] = order[live]
            order = moved
            width *= 2
        return order

    def same_bytes(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the windows at x and y agree byte by byte, for pairs whose hashes agree."""
        out = self.agree(x, y, self.length)
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        found = np.flatnonzero(out)
        for at in range(0, len(found), 20_000):
            part = found[at : at + 20_000]
            out[part] = (view[x[part]] == view[y[part]]).all(axis=1)
        return out


def sort_contexts(group: np.ndarray, text: list[bytes], to_anchor: np.ndarray, copies: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Windows of contexts in suffix order: (context, start, class, copies of the class).

    Windows are equal only at the same distance from the anchor of the same group.
    """
    sizes = np.array([len(t) for t in text])
    windows = sizes - length + 1
    begin = np.cumsum(sizes) - sizes
    context = np.repeat(np.arange(len(text)), windows)
    start = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    distance = to_anchor[context] - start + length
    bucket = np.unique(group, return_inverse=True)[1][context] * (4 * length) + distance
    suffixes = HashedSuffixes(np.frombuffer(b"".join(text), dtype=np.uint8), length)
    order = suffixes.sort(begin[context] + start, bucket)
    context, start, bucket = context[order], start[order], bucket[order]
    where = begin[context] + start
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = bucket[1:] != bucket[:-1]
    close = np.flatnonzero(~fresh)
    fresh[close] = ~suffixes.same_bytes(where[close - 1], where[close])
    kind = np.cumsum(fresh) - 1
    return context, start, kind, np.bincount(kind, weights=copies[context]).astype(np.int64)[kind]


def _sorted_ranges(contexts: DataFrame, length: int) -> DataFrame:
    """(g, e, low, high, digest, delta): the covered bytes of every context, relative to its start.

    Rows with a digest are windows that other chunks of the same group may match.
    ``contexts`` is dealt and sorted by (g, chunk).
    """

    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        g, e, copies, to_anchor = (rows[c].to_numpy() for c in ("g", "e", "copies", "to_anchor"))
        chunked, text = rows["chunked"].to_numpy(zero_copy_only=False), rows["bytes"].to_pylist()
        group = np.cumsum(changes(rows, ("g", "chunk"))) - 1
        context, start, kind, total = sort_contexts(group, text, to_anchor, copies, length)
        hit = total > 1
        low, high = np.full(len(g), 1 << 30), np.full(len(g), -1)
        np.minimum.at(low, context[hit], start[hit])
        np.maximum.at(high, context[hit], start[hit])
        found = np.flatnonzero(high >= 0)
        yield pa.record_batch({"g": g[found], "e": e[found], "low": low[found], "high": high[found] + length,
                               "delta": pa.nulls(len(found), pa.int64()), "digest": pa.nulls(len(found), pa.binary())})
        one = np.flatnonzero(np.diff(kind, prepend=-1).astype(bool) & chunked[context])
        if len(one):
            context, start = context[one], start[one]
            digests = [hashlib.blake2b(text[c][b : b + length], digest_size=16).digest() for c, b in zip(context.tolist(), start.tolist())]
            yield pa.record_batch({"g": g[context], "e": e[context], "low": start, "high": start + length,
                                   "delta": to_anchor[context] - start, "digest": pa.array(digests, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ("g", "chunk"), 2_000):
            yield from solve(rows)

    return contexts.mapInArrow(run, "g long, e long, low long, high long, delta long, digest binary")


# ---- operator ------------------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, text): rows with one id and text share their key, and what is removed from them."""
    k1, k2 = _keys(id_col, text_col)
    return docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))


def _keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), F.hash(text_col)


def byte_spans(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, start, stop) of the bytes that repeated strings cover, overlapping and in any order."""
    found = materialize(context_rows(keyed, length, gram))
    often = found.groupBy("g").agg(F.count("*").alias("n"), (F.min("e") != F.max("e")).alias("differ"))
    often = materialize(often.where(F.col("n") > 1).select("g", "differ"))
    repeated = materialize(found.join(often, "g"))

    differing = repeated.where("differ")
    classes = _classes(differing)
    large = materialize(classes.groupBy("g").agg(F.count("*").alias("k")).where(F.col("k") > CHUNK))
    wanted = classes.join(large, "g", "left").select(
        "at.*", "g", "e", "copies", F.col("k").isNotNull().alias("chunked"),
        F.pmod(F.col("e"), F.coalesce(F.ceil(F.col("k") / CHUNK), F.lit(1))).alias("chunk"),
    )
    asked = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "g", "e", "copies", "chunked", "chunk")).alias("asked"))
    contexts = _fetch(keyed.join(asked, ["k1", "k2"]), length)
    parts = contexts.repartition("g", "chunk").sortWithinPartitions("g", "chunk")
    ranges = materialize(_sorted_ranges(parts, length))
    covered = ranges.where(F.col("digest").isNull()).select("g", "e", "low", "high")
    if not large.isEmpty():
        windows = ranges.where(F.col("digest").isNotNull())
        across = materialize(windows.groupBy("g", "delta", "digest").agg(F.count("*").alias("k")).where(F.col("k") > 1))
        covered = covered.union(windows.join(across, ["g", "delta", "digest"]).select("g", "e", "low", "high"))
    return _placed(repeated, covered, length)


def _classes(differing: DataFrame) -> DataFrame:
    """One place of every different context, with its number of copies."""
    return materialize(differing.groupBy("g", "e").agg(F.count("*").alias("copies"), F.min(F.struct("k1", "k2", "place")).alias("at")))


def _placed(repeated: DataFrame, covered: DataFrame, length: int) -> DataFrame:
    """Ranges of contexts, given relative to their start, at all places of the contexts."""
    covered = materialize(covered.groupBy("g", "e").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    start = F.expr(_LOW)
    whole = repeated.where(~F.col("differ")).select("k1", "k2", start.alias("start"), (start + F.expr(_SPAN) + length).alias("stop"))
    part = repeated.where("differ").join(covered, ["g", "e"]).select("k1", "k2", (start + F.col("low")).alias("start"), (start + F.col("high")).alias("stop"))
    return whole.union(part)


def _spans(ranges: DataFrame) -> DataFrame:
    return _merged(ranges.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("spans")))


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the other columns of ``spans``, whose rows are found by key."""
    k1, k2 = _keys(id_col, text_col)
    spans = spans.withColumnsRenamed({"k1": "__k1", "k2": "__k2"})
    return docs.join(spans, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left").drop("__k1", "__k2")


def mark_repeats(
    docs: DataFrame, length: int = 400, gram: int = 100, id_col: str = "doc_id", text_col: str = "text", spans_col: str = "spans",
    words: int | None = None, words_col: str = "word_spans",
) -> DataFrame:
    """``docs`` with ``spans_col``: the byte ranges (start, stop) to remove, disjoint and ascending; NULL for none.

    With ``words`` also ``words_col``: ranges of words (numbered from 0, split at ASCII blanks) in runs of
    so many words that start at two places at least. The input's other columns keep their names and
    values; those named like the results are replaced.
    """
    docs = docs.drop(spans_col, words_col) if words else docs.drop(spans_col)
    keyed = _keyed(docs, id_col, text_col)
    spans = settled(docs.sparkSession, lambda: _spans(byte_spans(keyed, length, gram))).withColumnRenamed("spans", "__spans")
    if words:
        runs = settled(docs.sparkSession, lambda: _spans(word_spans(keyed, words))).withColumnRenamed("spans", "__words")
        spans = spans.join(runs, ["k1", "k2"], "full")
    marked = _with_spans(docs, spans, id_col, text_col).withColumnRenamed("__spans", spans_col)
    return marked.withColumnRenamed("__words", words_col) if words else marked


def _union(ranges: list[dict]) -> list[dict]:
    """Overlapping and touching ranges joined, ascending."""
    done: list[dict] = []
    for one in sorted(ranges, key=lambda r: r["start"]):
        if done and one["start"] <= done[-1]["stop"]:
            done[-1]["stop"] = max(done[-1]["stop"], one["stop"])
        else:
            done.append(one)
    return done


def _merged(spans: DataFrame) -> DataFrame:
    """(k1, k2, spans) with overlapping and touching ranges joined, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_union(ranges) for ranges in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, batch.schema.field(2).type)], schema=batch.schema)

    return spans.mapInArrow(run, spans.schema)


def _fetch(asked: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts asked for in each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for text, asked in zip(batch.column(0), batch.column(1)):
                raw = (text.as_py() or "").encode()
                for one in asked.as_py():
                    place = one["place"]
                    low, span = place >> 32, place >> 16 & 65535
                    rows.append((one["g"], one["chunk"], one["chunked"], one["e"], one["copies"], place & 65535, raw[low : low + span + length]))
                    size += length + span
                if size > 8_000_000:
                    yield _context_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _context_batch(rows)

    schema = "g long, chunk long, chunked boolean, e long, copies long, to_anchor long, bytes binary"
    return asked.select("text", "asked").mapInArrow(run, schema)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("g", "chunk", "chunked", "e", "copies", "to_anchor", "bytes")
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))


def without(raw: bytes, spans: list[dict] | None) -> bytes:
    """The bytes outside the spans."""
    out, at = [], 0
    for span in spans or ():
        out.append(raw[at : span["start"]])
        at = span["stop"]
    return b"".join([*out, raw[at:]])


def repeat_digests(marked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per marked row: id, n_bytes, n_removed, n_spans, kept_sha256, words in repeated runs of words, whether anything repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, count, sha, n_words = [], [], [], [], []
            for text, spans, runs in zip(batch.column(1), batch.column(2), batch.column(3)):
                raw, spans = (text.as_py() or "").encode(), spans.as_py() or []
                kept = without(raw, spans)
                size.append(len(raw))
                removed.append(len(raw) - len(kept))
                count.append(len(spans))
                sha.append(hashlib.sha256(kept).hexdigest())
                n_words.append(sum(r["stop"] - r["start"] for r in runs.as_py() or ()))
            yield pa.record_batch({"id": batch.column(0), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                                   "n_spans": pa.array(count, pa.int64()), "kept_sha256": pa.array(sha, pa.string()),
                                   "n_run_words": pa.array(n_words, pa.int64())})

    runs = F.col("word_spans") if "word_spans" in marked.columns else F.lit(None).cast(marked.schema["spans"].dataType)
    rows = marked.select(F.col(id_col).cast("long"), text_col, "spans", runs.alias("word_spans"))
    rows = rows.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_run_words long")
    rows = rows.withColumn("has_repeat", (F.col("n_removed") > 0) | (F.col("n_run_words") > 0))
    return rows.withColumnRenamed("id", id_col)


# ---- runs of words -----------------------------------------------------------------------------


def word_contexts(docs: DataFrame, words: int, gram: int) -> DataFrame:
    """(k1, k2, place, g, e) as ``context_rows``, counted in words."""
    # Parts of a very long text share words - 1 words, so every window lies in exactly one.
    step = PIECE - words + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            places = pa.RecordBatch.from_arrays([pa.array(np.arange(len(k1))), batch.column(2)], names=["i", "text"])
            for rows, texts in text_slices(iter([places]), 4 * PIECE):
                rows = np.array(rows)
                value, owner = word_hashes(texts, lower=False)
                for at in range(0, max(1, len(value)), step):
                    data, text = value[at : at + PIECE], owner[at : at + PIECE]
                    present, first = np.unique(text, return_index=True)
                    found = anchors(data, np.append(first[1:], len(data)), words, gram)
                    # Places count from the beginning of the text, which may lie before the part.
                    text_of = present[found["text"]] if len(present) else found["text"]
                    begin = np.searchsorted(owner, text_of) - at
                    place = _packed_place(found["low"] - begin, found["high"] - begin, found["anchor"] - begin)
                    row = rows[text_of]
                    yield pa.record_batch({"k1": k1[row], "k2": k2[row], "place": place, "g": found["g"].astype(np.int64), "e": found["e"].astype(np.int64)})

    return docs.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 int, place long, g long, e long")


def word_spans(keyed: DataFrame, words: int) -> DataFrame:
    """(k1, k2, start, stop) of words covered by runs of ``words`` words that start at two places at least."""
    found = materialize(word_contexts(keyed, words, min(WORD_GRAM, words)))
    often = found.groupBy("g").agg(F.count("*").alias("n"), (F.min("e") != F.max("e")).alias("differ"))
    often = materialize(often.where(F.col("n") > 1).select("g", "differ"))
    repeated = materialize(found.join(often, "g"))
    wanted = _classes(repeated.where("differ")).select("at.*", "g", "e", "copies")
    asked = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "g", "e", "copies")).alias("asked"))

    schema = pa.schema([("g", pa.int64()), ("e", pa.int64()), ("copies", pa.int64()), ("low", pa.int64()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, asked in zip(batch.column(0), batch.column(1)):
                split = (text.as_py() or "").encode().split()
                for one in asked.as_py():
                    low, span = one["place"] >> 32, one["place"] >> 16 & 65535
                    for k in range(span + 1):
                        digest = hashlib.blake2b(b" ".join(split[low + k : low + k + words]), digest_size=16).digest()
                        rows.append((one["g"], one["e"], one["copies"], k, digest))
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # Equal rows bring their contexts twice, which are repeated anyway.
    fetched = keyed.join(asked, ["k1", "k2"]).select("text", "asked")
    windows = materialize(fetched.mapInArrow(run, "g long, e long, copies long, low long, digest binary"))
    twice = windows.groupBy("digest").agg(F.sum("copies").alias("n")).where("n > 1").select("digest")
    covered = windows.join(twice, "digest").select("g", "e", "low", (F.col("low") + words).alias("high"))
    return _placed(repeated, covered, words)


def bytes_of_words(raw: bytes, runs: list[dict]) -> list[dict]:
    """Ranges of words as ranges of bytes."""
    bounds = [m.span() for m in _WORD.finditer(raw)]
    return [{"start": bounds[r["start"]][0], "stop": bounds[r["stop"] - 1][1]} for r in runs]


def remove_repeats(
    docs: DataFrame, length: int = 400, gram: int = 100, id_col: str = "doc_id", text_col: str = "text", words: int | None = None
) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text; characters cut in two are dropped.

    With ``words``, repeated runs of so many words (split at ASCII blanks) go as well, however few bytes they have.
    """
    marked = mark_repeats(docs, length, gram, id_col, text_col, "__repeats", words, "__runs")
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            text = []
            for t, spans, *runs in zip(batch.column(at), *batch.columns[width:]):
                spans, runs = spans.as_py() or [], [one for r in runs for one in r.as_py() or ()]
                raw = t.as_py().encode() if spans or runs else b""
                cut = _union([*spans, *bytes_of_words(raw, runs)])
                text.append(without(raw, cut).decode("utf-8", "ignore") if cut else t.as_py())
            columns = list(batch.columns[:width])
            columns[at] = pa.array(text, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:width])

    return marked.mapInArrow(run, docs.schema)
