"""Brown class-based bigram model: exchange clustering, class transitions, word emissions.

Words (runs without blanks, A-Z lower-cased) are followed by one end token per text.
Clustering has two steps. The ``frequent`` most frequent words are units of their own and
all other words with the same hashed ending form a unit together; exchange clustering
moves these units between classes as long as that raises the likelihood of the class
bigrams. Then every other word of the training texts is moved on its own: its counts of
classes before and behind it, over all its occurrences, decide which class raises the
likelihood most. All words of a round are judged against the class bigrams before the
round; a round that does not raise the likelihood is not taken. The class of an ending
remains for words that no training text has. A token then has probability
P(class | class before) * P(word | class), both smoothed, so that a word never seen
shares its class's rest mass.

Corpus statistics cover every training text: word counts and the counts of (word, class
beside it) are combined in tasks and in shuffles and stay tables; the driver gets unit
and class bigrams only, whose size is fixed. Counts and classes of the ``head`` most
frequent words, a stated bound, are sent to the tasks; rarer words meet the full table
in a join.

Defined results: a NULL or empty text is its end token alone; without training texts
every probability is a smoothed constant; a text that occurs twice is scored twice; a
row without id is learnt from and is not held out; a text of any length is read whole, as a
slice of its own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.text_units import text_slices
from diamondlake.operators.materialize import materialize, settled

#: Bounds: units by word and by ending, classes, and words whose counts are sent to tasks.
FREQUENT, ENDINGS, CLASSES = 1_024, 512, 128
HEAD, HEAD_BYTES = 200_000, 64
FLUSH = 400_000
#: Characters tokenised at once.
SLICE = 3_000_000
#: Rounds over the words that are no units, and contexts judged at once.
ROUNDS, ENTRIES = 1, 1_000
#: Characters whose contexts are counted together, and one packed context.
CONTEXT_SLICE, PACKED = 6_000_000, np.dtype([("beside", "<u2"), ("n", "<u4")])
#: Log of how much likelier a word's class is that of its ending than another one, before its contexts are known.
#: Chosen among 0, 2.4, 4.8 and 10 by the scores of training fold 2, learnt from the other training folds alone.
STAY = 4.8
#: The end token as a word; no text can contain it, as it holds a blank.
END = b" "
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens(text: str) -> list[bytes]:
    """The words of a text, then the end token."""
    found = text.encode().translate(_LOWER).split()
    found.append(END)
    return found


def coded(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``tokens`` of all texts as places in a list of different words, and tokens per text.

    END is the last word of the list, which may hold words that do not occur.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
    found = split.flatten().dictionary_encode()
    words, code = found.dictionary, np.asarray(found.indices).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.asarray(split.value_lengths()))
    # Blanks at the borders of a text give empty words.
    filled = np.append(np.asarray(pc.binary_length(words)) > 0, True)[code]
    size = np.bincount(owner[filled], minlength=len(texts)) + 1
    out = np.full(size.sum(), len(words))
    inner = np.ones(len(out), dtype=bool)
    inner[np.cumsum(size) - 1] = False
    out[inner] = code[filled]
    return pa.concat_arrays([words.cast(pa.binary()), pa.array([END], pa.binary())]), out, size


class Lexicon(list):
    """The frequent words, and the table (word, n, kind) of all words."""

    def __init__(self, frequent: list[bytes], table: DataFrame):
        super().__init__(frequent)
        self.table = table

    @cached_property
    def kinds(self) -> dict[bytes, int]:
        """Classes of all words, on the driver: to look into models of few words; no task asks for it."""
        found = self.table.select("word", "kind").toArrow()
        return dict(zip(found["word"].to_pylist(), found["kind"].to_pylist()))


class UnitOf(dict):
    """Word -> unit; a word that is no unit of its own belongs to the unit of its ending.

    With a model's ``Lexicon`` the words it has learnt have one unit per class, behind the endings.
    """

    def __init__(self, frequent: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(frequent))
        self.own = len(frequent)
        self.lexicon = frequent if isinstance(frequent, Lexicon) else None

    def __missing__(self, word: bytes) -> int:
        if self.lexicon is not None and word in self.lexicon.kinds:
            unit = self.own + ENDINGS + self.lexicon.kinds[word]
        else:
            unit = self.own + zlib.crc32(word[-2:]) % ENDINGS
        if len(self) < FLUSH:
            self[word] = unit
        return unit


def unit_places(words: pa.Array, own: pa.Array) -> np.ndarray:
    """``UnitOf`` of all words at once, for units without a ``Lexicon``."""
    place = places(words, own)
    unknown = np.flatnonzero(place < 0)
    place[unknown] = len(own) + endings(words.take(pa.array(unknown)))
    return place


def places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of every word in ``known``, -1 for a word that is not there."""
    return np.array(pc.index_in(words, value_set=known).fill_null(-1), dtype=np.int64)


def endings(words: pa.Array) -> np.ndarray:
    """Hashed ending of every word; each different ending is hashed once."""
    last = pc.binary_slice(words, -2).dictionary_encode()
    hashed = np.array([zlib.crc32(e) % ENDINGS for e in last.dictionary.to_pylist()], dtype=np.int64)
    return hashed[np.asarray(last.indices)]


# ---- corpus statistics -----------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the ``text`` column, without the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"word": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
        for _, texts in text_slices(batches, SLICE):
            words, code, _ = coded(texts)
            n = np.bincount(code)[:-1]
            met = pa.array(np.flatnonzero(n))
            held = pa.concat_tables([held, pa.table({"word": words.take(met), "n": pa.array(n).take(met)})])
            if len(held) > 2 * FLUSH:
                held = _summed(held)
                if len(held) > FLUSH:
                    yield from held.to_batches()
                    held = held.slice(0, 0)
        yield from _summed(held).to_batches()

    def _summed(held: pa.Table) -> pa.Table:
        out = held.group_by("word", use_threads=False).aggregate([("n", "sum")])
        return pa.table({"word": out["word"], "n": out["n_sum"]})

    rows = docs.select(F.lit(0).alias("id"), "text").mapInArrow(run, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def unit_bigrams(docs: DataFrame, frequent: list[bytes]) -> np.ndarray:
    """Counts of (unit before, unit); the first token of a text follows an end token."""
    size = len(frequent) + ENDINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.array(frequent, pa.binary())
        end = unit_places(pa.array([END], pa.binary()), own)
        total = np.zeros(size * size, dtype=np.int64)
        for _, texts in text_slices(batches, SLICE):
            words, code, _ = coded(texts)
            units = unit_places(words, own)[code]
            before = np.concatenate((end, units[:-1]))
            total += np.bincount(before * size + units, minlength=size * size)
        found = np.flatnonzero(total)
        yield pa.record_batch({"pair": found, "n": total[found]})

    rows = docs.select(F.lit(0).alias("id"), "text").mapInArrow(run, "pair long, n long")
    # At most size squared rows.
    summed = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[summed["pair"].to_numpy()] = summed["n"].to_numpy()
    return out.reshape(size, size)


# ---- exchange clustering -------------------------------------------------------------------


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = 10) -> np.ndarray:
    """Class of every unit.

    Units start round robin by frequency. One after the other is taken out of its
    class and put where the likelihood of the class bigrams is highest, until a
    sweep moves none.
    """
    size = len(bigrams)
    weight = bigrams.sum(0) + bigrams.sum(1)
    order = np.argsort(-weight, kind="stable")
    kind = np.zeros(size, dtype=np.int64)
    kind[order] = np.arange(size) % classes
    member = np.eye(classes)[kind]
    after, ahead = bigrams @ member, member.T @ bigrams  # unit x class, class x unit
    table = member.T @ after
    own = np.diag(bigrams)
    diagonal = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for u in order.tolist():
            if not weight[u]:
                continue
            a, s = kind[u], own[u]
            right, left = after[u].copy(), ahead[:, u].copy()
            right[a] -= s
            left[a] -= s
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= s
            # Wherever u goes, the other classes get back what they had next to it.
            rows, columns = table.sum(1) + left, table.sum(0) + right
            gain = (_h(table + right) - _h(table)).sum(1) + (_h(table + left[:, None]) - _h(table)).sum(0)
            corner = table[diagonal, diagonal]
            gain += _h(corner + right + left + s) + _h(corner) - _h(corner + right) - _h(corner + left)
            gain -= _h(rows + right.sum() + s) - _h(rows) + _h(columns + left.sum() + s) - _h(columns)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            table[b] += right
            table[:, b] += left
            table[b, b] += s
            if b != a:
                moved += 1
                kind[u] = b
                after[:, a] -= bigrams[:, u]
                after[:, b] += bigrams[:, u]
                ahead[a] -= bigrams[u]
                ahead[b] += bigrams[u]
        if not moved:
            break
    return kind


# ---- classes of all other words ------------------------------------------------------------


@dataclass
class Head:
    """The words that tasks know: END first, then by frequency."""

    words: list[bytes]
    n: np.ndarray
    kind: np.ndarray


def with_words(
    docs: DataFrame, head: Head, own: list[bytes], ending: np.ndarray, table: DataFrame, keep_text: bool = False
) -> DataFrame:
    """(id, at, met), or with ``keep_text`` (id, text, at, met), of (id, text) rows.

    ``at`` has a place in ``head`` per token, or -1 - i for the word of place i in ``met``, which
    lists (i, kind, n) of the row's other words; those not in ``table`` have n 0 and their ending's class.
    """
    shared = docs.sparkSession.sparkContext.broadcast((pa.array(head.words, pa.binary()), pa.array(own, pa.binary()), ending))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own, ending = shared.value
        for ids, texts in text_slices(batches, SLICE):
            listed, code, sizes = coded(texts)
            place = places(listed, words).astype(np.int32)
            unknown = np.flatnonzero(place < 0)
            home = np.zeros(len(listed), dtype=np.int32)
            home[unknown] = ending[unit_places(listed.take(pa.array(unknown)), own)]
            at = place[code]
            rare = np.flatnonzero(at < 0)
            row = np.repeat(np.arange(len(texts)), sizes)[rare]
            pairs, back = np.unique(row * len(listed) + code[rare], return_inverse=True)
            row, met = pairs // len(listed), pairs % len(listed)
            many = np.bincount(row, minlength=len(texts))
            at[rare] = -1 - (np.arange(len(pairs)) - (np.cumsum(many) - many)[row])[back]
            entries = pa.StructArray.from_arrays([listed.take(pa.array(met)), pa.array(home[met])], names=["word", "ending"])
            yield pa.record_batch({
                "id": pa.array(ids, pa.int64()), **({"text": pa.array(texts, pa.string())} if keep_text else {}),
                "at": pa.ListArray.from_arrays(_bounds(sizes), pa.array(at)),
                "rare": pa.ListArray.from_arrays(_bounds(many), entries),
            })

    kept = "text string, " if keep_text else ""
    rows = docs.mapInArrow(run, f"id long, {kept}at array<int>, rare array<struct<word: binary, ending: int>>")
    # Numbered and written once, so that the parts of a row find each other again.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()))
    rare = rows.select("row", F.posexplode("rare").alias("i", "one")).select("row", "i", "one.*")
    met = rare.join(table, "word", "left").select("row", "i", F.coalesce("kind", "ending").alias("kind"), F.coalesce("n", F.lit(0)).alias("n"))
    met = met.groupBy("row").agg(F.collect_list(F.struct("i", "kind", "n")).alias("met"))
    return rows.drop("rare").join(met, "row", "left").drop("row")


def _bounds(sizes: list[int]) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())


def met_tokens(batch: pa.RecordBatch, n: np.ndarray, kind: np.ndarray, least: int = 1_000_000) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, tokens per row, n and kind of every token) of ``with_words`` rows, some at a time."""
    every = batch.column(batch.schema.get_field_index("at"))
    long = np.cumsum(np.asarray(every.value_lengths())) // least
    cuts = [0, *(np.flatnonzero(np.diff(long)) + 1).tolist(), len(batch)]
    for low, high in zip(cuts, cuts[1:]):
        part = batch.slice(low, high - low)
        at, met = (part.column(batch.schema.get_field_index(c)) for c in ("at", "met"))
        sizes, flat = np.asarray(at.value_lengths()), np.asarray(at.flatten())
        many = np.asarray(met.value_lengths().fill_null(0))
        one = met.flatten()
        place = np.repeat(np.cumsum(many) - many, many) + np.asarray(one.field("i"))
        met_n, met_kind = np.zeros(len(one), dtype=np.int64), np.zeros(len(one), dtype=np.int64)
        met_n[place], met_kind[place] = np.asarray(one.field("n")), np.asarray(one.field("kind"))
        rare = np.flatnonzero(flat < 0)
        out_n, out_kind = n[np.maximum(flat, 0)], kind[np.maximum(flat, 0)]
        source = np.repeat(np.cumsum(many) - many, sizes)[rare] - 1 - flat[rare]
        out_n[rare], out_kind[rare] = met_n[source], met_kind[source]
        yield slice(low, high), sizes, out_n, out_kind


def _contexts(words: pa.Array, codes: np.ndarray, kinds: np.ndarray, own: pa.Array, end_kind: int, classes: int) -> pa.RecordBatch:
    """(word, kind, packed): classes before (k) and behind (classes + k) every word that is not in ``own``, with counts.

    The text is given as places in ``words`` and has the classes ``kinds``.
    """
    where = np.flatnonzero((places(words, own) < 0)[codes])
    before = np.concatenate(([end_kind], kinds[:-1]))
    kind = np.zeros(len(words), dtype=np.int64)
    kind[codes] = kinds
    # A word always has a token behind it, as texts close with END.
    beside = np.concatenate([before[where], classes + kinds[where + 1]])
    pairs, n = np.unique(np.tile(codes[where], 2) * (2 * classes) + beside, return_counts=True)
    code, size = np.unique(pairs // (2 * classes), return_counts=True)
    packed = np.empty(len(pairs), dtype=PACKED)
    packed["beside"], packed["n"] = pairs % (2 * classes), n
    bounds = pa.py_buffer(np.concatenate(([0], np.cumsum(size) * PACKED.itemsize)).astype(np.int32))
    lists = pa.Array.from_buffers(pa.binary(), len(code), [None, bounds, pa.py_buffer(packed.tobytes())])
    return pa.record_batch({"word": words.take(pa.array(code)), "kind": pa.array(kind[code], pa.int32()), "packed": lists})


_CONTEXT = "word binary, kind int, packed binary"


def first_contexts(docs: DataFrame, own: list[bytes], kind: np.ndarray, classes: int) -> DataFrame:
    """Contexts while words that are no units have their ending's class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = pa.array(own, pa.binary())
        for _, texts in text_slices(batches, CONTEXT_SLICE):
            words, code, _ = coded(texts)
            kinds = kind[unit_places(words, fixed)][code]
            yield _contexts(words, code, kinds, fixed, int(kind[0]), classes)

    return docs.select(F.lit(0).alias("id"), "text").mapInArrow(run, _CONTEXT)


def later_contexts(rows: DataFrame, head: Head, own: list[bytes], classes: int) -> DataFrame:
    """Contexts of ``with_words`` rows."""
    n, kind = head.n, head.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = pa.array(own, pa.binary())
        for batch in batches:
            for rows, _, _, kinds in met_tokens(batch, n, kind):
                words, code, _ = coded(batch.column(0)[rows].to_pylist())
                yield _contexts(words, code, kinds, fixed, int(kind[0]), classes)

    return rows.select("text", "at", "met").mapInArrow(run, _CONTEXT)


def class_bigrams(rows: DataFrame, head: Head, classes: int) -> np.ndarray:
    """Counts of (class before, class) over ``with_words`` rows."""
    n, kind = head.n, head.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, dtype=np.int64)
        for batch in batches:
            for _, _, _, kinds in met_tokens(batch, n, kind):
                before = np.concatenate((kind[:1], kinds[:-1]))
                total += np.bincount(before * classes + kinds, minlength=classes * classes)
        found = np.flatnonzero(total)
        yield pa.record_batch({"pair": found, "n": total[found]})

    # At most classes squared rows.
    summed = rows.select("at", "met").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(classes * classes)
    out[summed["pair"].to_numpy()] = summed["n"].to_numpy()
    return out.reshape(classes, classes)


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the class bigrams, up to what all clusterings share."""
    return float(_h(table).sum() - _h(table.sum(0)).sum() - _h(table.sum(1)).sum())


def best_kinds(size: np.ndarray, kind: np.ndarray, beside: np.ndarray, n: np.ndarray, table: np.ndarray, home: np.ndarray, stay: float) -> np.ndarray:
    """Class of each word that raises the likelihood most, all others left where they are.

    Word i has ``size[i]`` contexts (``beside``, ``n``) in turn and is in class ``kind[i]``. What a
    word has beside itself and beside its new class counts as if that did not move with it.
    The class ``home[i]`` is a priori more likely by ``stay``, in natural logarithms.
    """
    beside_of = np.concatenate([table, table.T])  # before: [k, class]; behind: [k, class]
    now_of = _h(beside_of)
    once = _h(beside_of + 1) - now_of
    totals = [(total, _h(total)) for total in (table.sum(1), table.sum(0))]
    out, most = kind.copy(), n.max(initial=0) + 1
    stop = np.cumsum(size)
    cuts = [0, *(np.flatnonzero(np.diff(stop // ENTRIES)) + 1).tolist(), len(size)]
    for low, high in zip(cuts, cuts[1:]):
        if low == high:
            continue
        one = slice(stop[low] - size[low], stop[high - 1])
        b, m, at = beside[one], n[one].astype(float), stop[low:high] - size[low:high] - (stop[low] - size[low])
        gain = once[b]
        many = np.flatnonzero(m > 1)
        alike, back = np.unique(b[many] * most + n[one][many], return_inverse=True)
        gain[many] = (_h(beside_of[alike // most] + (alike % most)[:, None]) - now_of[alike // most])[back]
        now = np.repeat(kind[low:high], size[low:high])
        held = beside_of[b, now]
        gain[np.arange(len(b)), now] = _h(held) - _h(np.maximum(held - m, 0))
        gain = np.add.reduceat(gain, at, axis=0)
        each = np.add.reduceat(m, at) / 2  # one context before and one behind per occurrence
        own = kind[low:high]
        value, back = np.unique(each, return_inverse=True)
        for total, now_total in totals:
            loss = (_h(total + value[:, None]) - now_total)[back]
            loss[np.arange(high - low), own] = now_total[own] - _h(np.maximum(total[own] - each, 0))
            gain -= loss
        more = np.arange(high - low)
        gain[more, home[low:high]] += stay
        best = gain.argmax(1)
        out[low:high] = np.where(gain[more, best] > gain[more, own] + 1e-9, best, own)
    return out


def moved(contexts: DataFrame, table: np.ndarray, ending: np.ndarray, stay: float) -> DataFrame:
    """(word, n, kind) of every word with contexts after one round of moves; ``ending`` has the classes of endings."""

    classes = len(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_words(batches):
            words, kind, raw = batch.columns
            first = _starts(words)
            entries = np.frombuffer(b"".join(raw.to_pylist()), dtype=PACKED)
            word = np.repeat(np.cumsum(first) - 1, np.asarray(pc.binary_length(raw)) // PACKED.itemsize)
            first = pa.array(np.flatnonzero(first))
            words, kind = words.take(first), np.asarray(kind.take(first)).astype(np.int64)
            pairs, place = np.unique(word * (2 * classes) + entries["beside"], return_inverse=True)
            n = np.bincount(place, weights=entries["n"]).astype(np.int64)
            size = np.bincount(pairs // (2 * classes), minlength=len(words))
            kind = best_kinds(size, kind, pairs % (2 * classes), n, table, ending[endings(words)], stay)
            total = np.add.reduceat(n, np.cumsum(size) - size) // 2
            yield pa.record_batch({"word": words, "n": total, "kind": pa.array(kind, pa.int32())})

    # A word has one row per slice of text at most; they lie side by side.
    rows = contexts.repartition("word").sortWithinPartitions("word")
    return rows.mapInArrow(run, "word binary, n long, kind int")


def _starts(words: pa.Array) -> np.ndarray:
    """Whether a word differs from the one before."""
    return np.append(True, np.asarray(pc.not_equal(words[1:], words[:-1])))


def whole_words(batches: Iterator[pa.RecordBatch], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Batches sorted by their first column, ``word``, cut anew: about ``rows`` rows each, all rows of a word in one."""
    held: list[pa.RecordBatch] = []
    for whole in batches:
        for at in range(0, len(whole), rows):
            batch = whole.slice(at, rows)
            starts = np.flatnonzero(_starts(batch.column(0)))
            if held and held[-1].column(0)[-1] == batch.column(0)[0]:
                starts = starts[1:]
            if not len(starts):
                held.append(batch)
                continue
            # What lies before the last word is complete.
            held.append(batch.slice(0, starts[-1]))
            done = pa.concat_batches(held)
            if len(done):
                yield done
            held = [batch.slice(starts[-1])]
    if held:
        yield pa.concat_batches(held)


# ---- model --------------------------------------------------------------------------------------


@dataclass
class BrownModel:
    """Everything a task needs, of bounded size, and the table (word, n, kind) of all words.

    ``kind`` has the classes of the units: frequent words, endings, then one unit per class.
    """

    frequent: Lexicon
    kind: np.ndarray
    transition: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    head: Head
    counts: DataFrame
    train_tokens: int
    train_words: int
    emission_mass: float = 0.5
    #: Rows of ``prepare`` with their words found in ``counts``, where ``train`` was given any.
    rows: DataFrame | None = None


def train(
    docs: DataFrame, classes: int = CLASSES, frequent: int = FREQUENT, head: int = HEAD, prior: float = 5.0,
    rounds: int = ROUNDS, stay: float = STAY, prepare: DataFrame | None = None, learns: Column | None = None,
) -> BrownModel:
    """Learn from all rows of ``docs`` (column ``text``).

    ``prepare`` are the (id, text) rows to be scored later; if ``learns``, a condition on ``id``, picks the
    rows of ``docs`` from them, the last round and the scoring share one pass over the texts.
    """
    counts = materialize(word_counts(docs))
    n_docs = docs.count()
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    best = _most_frequent(counts, head)
    words = best["word"].to_pylist()
    own = [END, *words[: frequent - 1]]
    bigrams = unit_bigrams(docs, own)
    kind = exchange(bigrams, classes)
    member = np.eye(classes)[kind]
    table = member.T @ bigrams @ member

    # Every word in its ending's class, then the rounds.
    taken, score_now = None, likelihood(table)
    first = unit_places(best["word"].combine_chunks(), pa.array(own, pa.binary()))
    known = Head([END, *words], np.append(n_docs, best["n"].to_numpy()).astype(np.int64), np.append(kind[0], kind[first]))
    units = pa.table({"word": best["word"], "n": best["n"], "kind": pa.array(kind[first], pa.int32())}).slice(0, len(own) - 1)
    contexts = first_contexts(docs, own, kind, classes)
    spark, prepared = docs.sparkSession, None
    for left in range(rounds - 1, -1, -1):
        found = moved(contexts, table, kind[len(own) :], stay)
        found = materialize(found.unionByName(spark.createDataFrame(units)))
        head_now = _head(found, head, n_docs, kind)
        shared = not left and prepare is not None
        source = prepare.select("id", "text") if shared else docs.select(F.lit(0).cast("long").alias("id"), "text")
        rows = settled(spark, lambda: with_words(source, head_now, own, kind, found, left > 0))
        table_now = class_bigrams(rows.where(learns) if shared else rows, head_now, classes)
        if likelihood(table_now) <= score_now:
            break
        table, score_now, known, taken = table_now, likelihood(table_now), head_now, found
        if left:
            contexts = later_contexts(rows, head_now, own, classes)
        prepared = rows if shared else None
    final = materialize(_with_endings(counts, own, kind)) if taken is None else taken

    tokens_of = table.sum(0)
    share = (tokens_of + 1) / (tokens_of.sum() + classes)
    transition = np.log10((table + prior * share) / (table.sum(1, keepdims=True) + prior))
    words_of = np.zeros(classes)
    per = final.groupBy("kind").agg(F.count("*").alias("n")).toArrow()
    words_of[per["kind"].to_numpy()] = per["n"].to_numpy()
    words_of[kind[0]] += 1 if n_docs else 0
    return BrownModel(
        Lexicon(own, final), np.concatenate([kind, np.arange(classes)]), transition, tokens_of, words_of, known, final,
        int(totals["n"]) + n_docs, int(totals["v"]) + (1 if n_docs else 0), rows=prepared,
    )


def _most_frequent(counts: DataFrame, head: int) -> pa.Table:
    return counts.where(F.length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "word").limit(head).toArrow()


def _head(table: DataFrame, head: int, n_docs: int, kind: np.ndarray) -> Head:
    """END and the ``head`` most frequent words with the classes they have in ``table``."""
    best = _most_frequent(table.select("word", "n", "kind"), head)
    n, kinds = best["n"].to_numpy().astype(np.int64), best["kind"].to_numpy().astype(np.int64)
    return Head([END, *best["word"].to_pylist()], np.concatenate(([n_docs], n)), np.concatenate((kind[:1], kinds)))


def _with_endings(counts: DataFrame, own: list[bytes], kind: np.ndarray) -> DataFrame:
    """(word, n, kind): words that are no units with the class of their ending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = pa.array(own, pa.binary())
        for batch in batches:
            yield pa.record_batch({"word": batch.column(0), "n": batch.column(1), "kind": pa.array(kind[unit_places(batch.column(0), units)], pa.int32())})

    return counts.select("word", "n").mapInArrow(run, "word binary, n long, kind int")


def score(docs: DataFrame, model: BrownModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_tokens, n_known, base_score, score (both log10 of the text's probability).

    If the model has prepared its rows, ``docs`` must be those.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = model.rows
    if rows is None:
        rows = settled(docs.sparkSession, lambda: with_words(named, model.head, list(model.frequent), model.kind, model.counts))
    head_n, head_kind, transition = model.head.n, model.head.kind, model.transition
    whole, mass = model.train_tokens + 0.5 * (model.train_words + 1), model.emission_mass
    rest = model.class_tokens + mass * (model.class_words + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sizes, n, kind in met_tokens(batch, head_n, head_kind):
                before = np.concatenate((head_kind[:1], kind[:-1]))
                step = transition[before, kind] + np.log10((n + mass) / rest[kind])
                at = np.cumsum(sizes) - sizes
                yield pa.record_batch({
                    "id": batch.column(0)[part], "n_tokens": pa.array(sizes, pa.int64()), "n_known": np.add.reduceat((n > 0).astype(np.int64), at),
                    "base": np.add.reduceat(np.log10((n + 0.5) / whole), at), "score": np.add.reduceat(step, at),
                })

    scored = rows.mapInArrow(run, "id long, n_tokens long, n_known long, base double, score double")
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.col("base").alias("base_score"), "score")


def held_out(id_column: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether crc32 of the id as text falls into the fold that is never learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == fold, F.lit(False))
