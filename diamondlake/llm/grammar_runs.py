"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of words with smallest period q (words q apart are identical) of at least
``least`` words and ``repeats`` periods that no neighbouring word extends with that period.

1. Re-Pair. Pairs of neighbouring symbols that occur twice in a text without overlapping become
   a new symbol, the most frequent ones first, until no pair repeats. All texts of a slice go
   through the rounds together; a round replaces every pair that comes before both pairs it
   overlaps (more occurrences, then older symbols). Where a symbol was made is a position of
   its derivation.
2. Boundaries. A run lies inside the expansion of a symbol, across the seam of its two parts,
   or across a seam between two symbols of the final sequence. The expansion of each symbol is
   looked at once, at its first position. Of the final seams only those at a made symbol
   count: a run of four periods over single words alone would repeat a pair.
3. Periods at a seam. A run of four periods or more has two of them on one side of the seam,
   so the words there stand q words further on again. Repeated stretches of 1, 2, 4, ... words
   have numbers (exact, by doubling); for periods from L up to 2L - 1 the places of the
   stretch of L words at the seam give the candidates, and their common extensions to
   both sides, found by the same numbers, the run inside the expansion.
4. Positions. Runs of a symbol hold at all its positions; stretches of one period that overlap by a
   period are one run, and of equal stretches the smallest period counts.

Defined results: a NULL or empty text has no words and no runs; texts of any length are read
whole (one text of any size is a slice of its own); each row is judged by itself, so repeated
rows, ids and NULL ids change nothing; an empty table gives no rows; of input columns that
carry the names of the results the input's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.text_units import text_slices

SLICE_CHARS = 3_000_000


def _starts(values: np.ndarray) -> np.ndarray:
    """Places where a sorted array changes, its first place included."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, dtype=np.int64)


@dataclass
class Grammar:
    """Symbols made from pairs, and the places where each was made."""

    #: Of every made symbol: length of its first part, length of its expansion.
    left: np.ndarray
    size: np.ndarray
    #: Places of all derivations, with their symbol (index into ``left``), by symbol and place.
    place: np.ndarray
    symbol: np.ndarray
    #: Seams of the final sequence at made symbols.
    seams: np.ndarray


def repair(words: np.ndarray, text: np.ndarray) -> Grammar:
    """Re-Pair over all texts of a slice; ``words`` of different texts differ."""
    n = len(words)
    symbol = words.astype(np.int64)
    size = np.ones(n + 1, dtype=np.int64)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.ones(n, dtype=bool)
    fresh = int(symbol.max(initial=-1)) + 1
    lefts, sizes, places, symbols = [], [], [], []
    made = 0
    active = np.flatnonzero(text[1:] == text[:-1]) if n else np.zeros(0, dtype=np.int64)
    priority = np.full(n + 1, -1, dtype=np.int64)
    while len(active):
        second = after[active]
        key = symbol[active] << 32 | symbol[second]
        # In a chain of one symbol (a a a a) only every other pair can be replaced.
        twin = symbol[active] == symbol[second]
        linked = np.zeros(len(active), dtype=bool)
        linked[1:] = twin[1:] & (key[1:] == key[:-1]) & (after[active[:-1]] == active[1:])
        index = np.arange(len(active))
        chain = index - np.maximum.accumulate(np.where(linked, 0, index))
        usable = chain % 2 == 0
        active, key = active[usable], key[usable]
        names, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        often = count[inverse] > 1
        active, inverse = active[often], inverse[often]
        if not len(active):
            break
        # More occurrences first, then older symbols: a smaller rank is a higher priority.
        rank = np.empty(len(names), dtype=np.int64)
        rank[np.lexsort((np.arange(len(names)), -count))] = np.arange(len(names), 0, -1)
        priority[active] = rank[inverse]
        own = priority[active]
        chosen = (own > priority[before[active]]) | (before[active] < 0) | (own == priority[before[active]])
        chosen &= own >= priority[after[active]]
        priority[active] = -1
        # A pair that its neighbours leave one place only waits.
        left_over = np.bincount(inverse[chosen], minlength=len(names))
        chosen &= left_over[inverse] > 1
        at, kind = active[chosen], inverse[chosen]
        kinds, kind = np.unique(kind, return_inverse=True)
        gone = after[at]
        own_left, whole = size[at], size[at] + size[gone]
        first = np.zeros(len(kinds), dtype=np.int64)
        first[kind[::-1]] = np.arange(len(kind))[::-1]
        lefts.append(own_left[first])
        sizes.append(whole[first])
        places.append(at)
        symbols.append(made + kind)
        made += len(kinds)
        symbol[at] = fresh + kind
        fresh += len(kinds)
        size[at] = whole
        alive[gone] = False
        beyond = after[gone]
        after[at] = beyond
        inner = beyond < n
        before[beyond[inner]] = at[inner]
        previous = before[at]
        active = np.unique(np.concatenate((active[alive[active]], at, previous[previous >= 0])))
        follow = after[active]
        inside = follow < n
        inside[inside] = text[active[inside]] == text[follow[inside]]
        active = active[inside]
    final = np.flatnonzero(alive)
    big = size[final] > 1
    pair = np.flatnonzero(text[final[1:]] == text[final[:-1]]) if len(final) else np.zeros(0, dtype=np.int64)
    seams = final[pair[big[pair] | big[pair + 1]] + 1]
    none = np.zeros(0, dtype=np.int64)
    place, made_symbol = (np.concatenate(parts) if parts else none for parts in (places, symbols))
    order = np.lexsort((place, made_symbol))
    return Grammar(*(np.concatenate(parts) if parts else none for parts in (lefts, sizes)), place[order], made_symbol[order], seams)


class Stretches:
    """Numbers of the repeated stretches of 1, 2, 4, ... words: equal numbers, equal words."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        place, name = self._repeated(np.arange(len(words)), words)
        width = 1
        while len(place):
            # Beside the numbers by place, all (number, place) in order.
            self.levels.append((place, name, np.sort(name * self.n + place)))
            here, there, found = self._find(place, name, place + width)
            place, name = self._repeated(place[found], here[found] << 32 | there[found])
            width *= 2

    @staticmethod
    def _repeated(place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(place):
            return place, key
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        often = count[inverse] > 1
        return place[often], inverse[often].astype(np.int64)

    @staticmethod
    def _find(place: np.ndarray, name: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(place, other), len(place) - 1)
        return name, name[at], place[at] == other

    def name(self, level: int, at: np.ndarray) -> np.ndarray:
        """Numbers of the stretches that begin at the places; -1 for none that repeats."""
        place, name, _ = self.levels[level]
        where = np.minimum(np.searchsorted(place, at), len(place) - 1)
        return np.where(place[where] == at, name[where], -1)

    def again(self, level: int, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``at``, place): where the stretch of a place stands again, from low up to high - 1."""
        name = self.name(level, at)
        known = np.flatnonzero((name >= 0) & (low < high))
        _, _, order = self.levels[level]
        base = name[known] * self.n
        first = np.searchsorted(order, base + np.maximum(low[known], 0))
        count = np.searchsorted(order, base + np.minimum(high[known], self.n)) - first
        count = np.maximum(count, 0)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(known, count), order[np.repeat(first, count) + step] - np.repeat(base, count)

    def extension(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """Number of equal words from x and y on, or, going back, before them."""
        done = np.zeros(len(x), dtype=np.int64)
        for level in reversed(range(len(self.levels))):
            width = 1 << level
            shift = -done - width if back else done
            one, two = self.name(level, x + shift), self.name(level, y + shift)
            done += width * ((one == two) & (one >= 0))
        return done


def seam_runs(stretches: Stretches, seam: np.ndarray, low: np.ndarray, high: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, ...]:
    """(index of the seam, start, stop, period) of the runs across each seam, inside low to high."""
    seams, periods, anchors = [], [], []
    for level in range(len(stretches.levels)):
        width = 1 << level
        # To the right: the stretch at the seam again, q words on.
        index, place = stretches.again(level, seam, seam + width, np.minimum(seam + 2 * width, high - width + 1))
        seams.append(index)
        periods.append(place - seam[index])
        anchors.append(seam[index])
        # To the left: the stretch before the seam, q words earlier.
        inside = np.flatnonzero(seam - width >= low)
        at = seam[inside] - width
        index, place = stretches.again(level, at, np.maximum(at - 2 * width + 1, low[inside]), at - width + 1)
        seams.append(inside[index])
        periods.append(at[index] - place)
        anchors.append(seam[inside[index]] - periods[-1])
    none = np.zeros(0, dtype=np.int64)
    index, q, x = (np.concatenate(parts) if parts else none for parts in (seams, periods, anchors))
    # Words at x and at x + q are equal where the side with two periods begins or ends.
    b, lo, hi = seam[index], low[index], high[index]
    stop = np.minimum(x + q + stretches.extension(x, x + q), hi)
    start = np.maximum(x - stretches.extension(x, x + q, back=True), lo)
    good = (start < b) & (stop > b) & (stop - start >= np.maximum(least, repeats * q))
    return index[good], start[good], stop[good], q[good]


def word_runs(words: np.ndarray, text: np.ndarray, least: int = 6, repeats: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of joined texts, by start and period. ``words`` of different texts differ."""
    if repeats < 4 or least < 3:
        raise ValueError("the seams rest on runs of four periods and three words at least")
    none = np.zeros(0, dtype=np.int64)
    grammar = repair(words, text)
    if not len(grammar.left):
        return none, none, none
    stretches = Stretches(words)
    first = _starts(grammar.symbol)
    origin = grammar.place[first]
    begin = np.searchsorted(text, text[grammar.seams])
    end = np.searchsorted(text, text[grammar.seams], side="right")
    seam = np.concatenate((origin + grammar.left, grammar.seams))
    low, high = np.concatenate((origin, begin)), np.concatenate((origin + grammar.size, end))
    index, start, stop, q = seam_runs(stretches, seam, low, high, least, repeats)
    # To every position of the symbol.
    inner = index < len(origin)
    of = index[inner]
    count = np.diff(np.append(first, len(grammar.place)))[of]
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    move = grammar.place[np.repeat(first[of], count) + step] - np.repeat(origin[of], count)
    start = np.concatenate((np.repeat(start[inner], count) + move, start[~inner]))
    stop = np.concatenate((np.repeat(stop[inner], count) + move, stop[~inner]))
    q = np.concatenate((np.repeat(q[inner], count), q[~inner]))
    # Stretches of one period that overlap by a period are one run; texts lie apart.
    order = np.lexsort((start, text[start], q))
    start, stop, q = start[order], stop[order], q[order]
    fresh = np.ones(len(start), dtype=bool)
    if len(start) > 1:
        # The greatest stop so far, within one period: periods lie far apart on one scale.
        scale = np.cumsum(np.concatenate(([0], q[1:] != q[:-1]))) * (len(words) + 1)
        reach = np.maximum.accumulate(stop + scale)
        fresh[1:] = (start + scale)[1:] + q[1:] > reach[:-1]
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(start)) - 1
        start, q, stop = start[first], q[first], reach[last] - scale[last]
    # Of equal stretches the smallest period.
    order = np.lexsort((q, stop, start))
    start, stop, q = start[order], stop[order], q[order]
    keep = np.ones(len(start), dtype=bool)
    keep[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, q = start[keep], stop[keep], q[keep]
    order = np.lexsort((q, start))
    return start[order], (stop - start)[order], q[order]


def numbered(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(number of every word, its text): equal words of one text have equal numbers, words of different texts differ."""
    known: dict[bytes, int] = {}
    number = np.array([known.setdefault(w, len(known)) for s in split for w in s], dtype=np.int64)
    text = np.repeat(np.arange(len(split)), [len(s) for s in split])
    return np.unique(text * max(1, len(known)) + number, return_inverse=True)[1].astype(np.int64), text


RUNS = "array<struct<start: long, length: long, period: long>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(
    docs: DataFrame, least: int = 6, repeats: int = 4, id_col: str = "doc_id", text_col: str = "text",
    runs_col: str = "runs", collapsed_col: str = "collapsed",
) -> DataFrame:
    """(id, runs, collapsed): the runs of every text by start and period, and its words joined by one space
    without those that any run repeats, that is, contains after its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_slices(batches, SLICE_CHARS):
            # bytes.split cuts at 0x20 and 0x09-0x0D.
            split = [t.encode().split() for t in texts]
            start, length, period = word_runs(*numbered(split), least, repeats)
            bounds = np.cumsum([0, *map(len, split)])
            of = np.searchsorted(bounds, start, side="right") - 1
            cut = np.searchsorted(of, np.arange(len(split) + 1))
            runs: list[list[dict]] = [[] for _ in split]
            for i in np.unique(of).tolist():
                words, part = split[i], slice(cut[i], cut[i + 1])
                begin = (start[part] - bounds[i]).tolist()
                drop = np.zeros(len(words), dtype=bool)
                for s, n, q in zip(begin, length[part].tolist(), period[part].tolist()):
                    runs[i].append({"start": s, "length": n, "period": q})
                    drop[s + q : s + n] = True
                split[i] = [words[k] for k in np.flatnonzero(~drop).tolist()]
            joined = pa.array([b" ".join(s) for s in split], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, _RUNS), joined], names=["id", runs_col, collapsed_col])

    found = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, f"id long, `{runs_col}` {RUNS}, `{collapsed_col}` string")
    return found.withColumnRenamed("id", id_col)
