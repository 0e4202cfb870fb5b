"""Cutting texts into units whose tokens do not depend on each other, and small helpers of map tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

#: Characters that \s means for the tokenizers' patterns (Unicode White_Space).
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RUN = re.compile(f"[{SPACE}]\\x20|\\x20[{SPACE}]")
_UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")

SLICE_CHARS = 4_000_000
CACHE_ENTRIES = 500_000


class UnitCache:
    """What a Python worker knows about units, in two generations of bounded size.

    When the new generation is full it becomes the old one; units that occur again
    move back. So frequent units stay, and memory does not grow with the corpus.
    """

    def __init__(self, limit: int = CACHE_ENTRIES):
        self.limit, self.known, self.old = limit, {}, {}

    def missing(self, units: set[str]) -> list[str]:
        """Those of ``units`` that have to be learnt; afterwards ``known`` must hold them all."""
        if len(self.known) >= self.limit:
            self.old, self.known = self.known, {}
        fresh = units.difference(self.known)
        again = fresh & self.old.keys()
        self.known.update((unit, self.old[unit]) for unit in again)
        return list(fresh - again)


def spaced_units(text: str) -> tuple[list[str], list[str]]:
    """(units as they are, units that are preceded by one space).

    A single space between two other characters always begins a new pre-token, so a
    text splits there; only texts with runs of white space need the slower pattern,
    where a unit is a run of white space with what follows it.
    """
    if _RUN.search(text):
        return _UNIT.findall(text), []
    first, *rest = text.split(" ")
    return [first], rest


def units_in_order(text: str) -> list[str]:
    plain, spaced = spaced_units(text)
    return plain + [" " + unit for unit in spaced]


def text_slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_CHARS) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of at most ``limit`` characters, or of one longer text; NULL texts are empty."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            if texts and size + len(text) > limit:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(key)
            texts.append(text)
            size += len(text)
        if texts:
            yield ids, texts
