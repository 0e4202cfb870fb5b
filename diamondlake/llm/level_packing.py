"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every task packs the documents of its own partition as they come. A document's full
windows are sequences of their own; what is left of it goes, uncut, to the fill level
that leaves the least sum of squared counts of partly filled windows. An array holds
the number of open windows per level, so a choice is one vector operation whatever
the number of open windows, and at most ``window - 1`` levels are ever open.

At the end of a partition the open windows are emptied into full ones by cutting; the
rest becomes sequences whose lengths are powers of two, which need no padding.

Defined results: a NULL or empty text is its end mark alone; a document that occurs
twice is packed twice; an empty table gives no piece. A retried task reads the same
rows in the same order and so gives the same pieces.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.prefix_bpe import byte_alphabet
from diamondlake.llm.text_units import UnitCache, text_slices

SCHEMA = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Words a worker remembers, per generation.
CACHED = 300_000


class UnitTokens:
    """Ids of whole texts from the ids of their words, over columns of a slice of texts.

    Texts fall into units at spaces, and every distinct unit of a slice is looked at once.
    A unit of letters below U+0300 without special strings cannot be changed by composition,
    so lower-casing and the file's own pattern give its words, and the library's model
    encodes each distinct word once. Any other unit goes through the library whole.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_json)
        with open(tokenizer_json, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
        cuts = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
            raise ValueError("not a lower-casing word vocabulary")
        # Spaces come out as well: they part the units that are cut together.
        self.word = re.compile(" |" + _spelled_out(cuts[0]["pattern"]["Regex"]))
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.other = "|".join(["[^\\t-\\r\\x20-\\x7e\\x{85}\\x{a0}-\\x{2ff}]", *special])
        self.stand_in = {byte: char for char, byte in byte_alphabet().items()}
        # They stay with the worker, so they are bounded well below a task's memory.
        self.words = UnitCache(CACHED)

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(self.stand_in)
        return array("I", [token.id for token in self.tokenizer.model.tokenize(word)]).tobytes()

    def _of_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every unit, one unit after the other, and how many each has."""
        other = pc.match_substring_regex(units, self.other)
        whole = np.flatnonzero(np.asarray(other))
        plain = pc.if_else(other, "", units)
        found = pa.array(self.word.findall(pc.binary_join(_as_one_list(plain), " ")[0].as_py().lower()), pa.string()).dictionary_encode()
        words, code = found.dictionary.to_pylist(), np.asarray(found.indices)
        gap = np.fromiter((w == " " for w in words), dtype=bool, count=len(words))[code]
        unit = np.cumsum(gap)[~gap]
        new = self.words.missing(set(words) - {" "})
        self.words.known.update((word, self._word(word)) for word in new)
        of_word = [self.words.known[w] if w != " " else b"" for w in words]
        size = np.fromiter(map(len, of_word), dtype=np.int64, count=len(words)) // 4
        code = code[~gap]
        ids = _gathered(np.frombuffer(b"".join(of_word), dtype="<u4"), size, code)
        many = np.bincount(unit, weights=size[code], minlength=len(units)).astype(np.int64)
        if not len(whole):
            return ids, many
        extra = []
        for at in range(0, len(whole), 20_000):
            part = units.take(pa.array(whole[at : at + 20_000])).to_pylist()
            extra += [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        # Those of whole units lie behind the others; an order of units brings both together.
        size = np.concatenate([many, np.fromiter(map(len, extra), dtype=np.int64, count=len(extra))])
        place = np.arange(len(units))
        place[whole] = len(units) + np.arange(len(whole))
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(extra), dtype="<u4")])
        return _gathered(ids, size, place), size[place]

    def packed(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        units = split.flatten().dictionary_encode()
        code = np.asarray(units.indices)
        ids, many = self._of_units(units.dictionary)
        raw = memoryview(_gathered(ids, many, code).tobytes())
        stop = np.concatenate(([0], np.cumsum(many[code])))[np.asarray(split.offsets)] * 4
        return [bytes(raw[a:b]) for a, b in zip(stop.tolist(), stop[1:].tolist())]


def _spelled_out(pattern: str) -> str:
    """The pattern with its letters and numbers listed, as far as lower-cased characters below U+0300 need them."""
    chars = sorted(set("".join(map(chr, range(0x300))).lower()))
    for name in "LN":
        listed = "".join(c for c in chars if unicodedata.category(c)[0] == name)
        pattern = pattern.replace(f"\\p{{{name}}}", listed)
    return pattern


def _as_one_list(strings: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings)


def _gathered(values: np.ndarray, size: np.ndarray, take: np.ndarray) -> np.ndarray:
    """Stretches of ``values``, of which ``size`` has the lengths in turn, in the order ``take``."""
    many = size[take]
    begin = (np.cumsum(size) - size)[take] - (np.cumsum(many) - many)
    return values[np.repeat(begin, many) + np.arange(many.sum())]


@lru_cache(maxsize=2)
def unit_tokens(tokenizer_json: str) -> UnitTokens:
    return UnitTokens(tokenizer_json)


@dataclass
class Piece:
    """Ids ``start`` to ``start + length`` of one document."""

    doc: int | None
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, size: int) -> tuple[Piece, Piece]:
        head, tail = self.ids[: 4 * size], self.ids[4 * size :]
        return Piece(self.doc, self.start, head, self.doc_tokens), Piece(self.doc, self.start + size, tail, self.doc_tokens)


class LevelPacker:
    """Open windows by fill level."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1)
        # Ends of the array that make one formula of all cases: a new window comes
        # from level 0, a filled one leaves at level ``window``.
        self.count[0], self.count[window] = 0.5, -0.5
        self.leaving = np.full(window + 1, -np.inf)
        self.leaving[0] = 0.5
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece shorter than the window into a level; the window if that fills it."""
        size, window = piece.length, self.window
        # Half the change of the sum of squares, less one, for every level that has room.
        change = self.count[size:] - self.leaving[: window - size + 1]
        level = window - size - int(np.argmin(change[::-1]))
        bin_ = self.open[level].pop() if level else []
        if level:
            self._add(level, -1)
        bin_.append(piece)
        if level + size == window:
            return bin_
        self.open[level + size].append(bin_)
        self._add(level + size, 1)
        return None

    def _add(self, level: int, n: int) -> None:
        self.count[level] += n
        self.leaving[level] = self.count[level] if self.count[level] > 0 else -np.inf

    def close(self) -> Iterator[list[Piece]]:
        """Empty the open windows: power-of-two fills as they are, the rest by cutting."""
        rest: list[Piece] = []
        for level in sorted(self.open, reverse=True):
            for bin_ in self.open[level]:
                if level & (level - 1) == 0:
                    yield bin_
                else:
                    rest += bin_
        left = sum(p.length for p in rest)
        rest.reverse()
        while left:
            room = min(self.window, 1 << (left.bit_length() - 1))
            left -= room
            bin_ = []
            while room:
                piece = rest.pop()
                if piece.length > room:
                    piece, tail = piece.cut(room)
                    rest.append(tail)
                room -= piece.length
                bin_.append(piece)
            yield bin_
        self.__init__(self.window)


def pack_documents(
    docs: DataFrame, tokenizer_json: str, end_id: int = 1, window: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    mark = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = unit_tokens(tokenizer_json), LevelPacker(window)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def emit(bin_: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for p in bin_:
                rows.append((p.doc, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, sequence, offset))
                offset += p.length
            sequence += 1

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            rows.clear()
            return pa.record_batch(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

        for keys, texts in text_slices(batches):
            for key, packed in zip(keys, tokens.packed(texts)):
                ids = packed + mark
                total = len(ids) // 4
                full = total - total % window
                for start in range(0, full, window):
                    emit([Piece(key, start, ids[4 * start : 4 * (start + window)], total)])
                if full < total:
                    filled = packer.place(Piece(key, full, ids[4 * full :], total))
                    if filled:
                        emit(filled)
            if rows:
                yield flushed()
        for bin_ in packer.close():
            emit(bin_)
        if rows:
            yield flushed()

    packed = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SCHEMA)
    return packed.withColumnRenamed("id", id_col)
