"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair tokens.

For every prefix of a pre-token there is one last token of its encoding. It is the
token that ends there, stands for itself, and joins the last token of the shorter
prefix without a merge across the seam. So one pass over the bytes stores count and
last token of every prefix, and truncation or budget questions are table look-ups:
nothing is encoded again.

Defined results: a NULL or empty text has no bytes and no tokens; special strings
inside a text are one token each, as the tokenizer's file says; a row that occurs twice is
counted twice, alike; a text of any length is counted whole, as a slice of its own; an empty
table gives no rows.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.text_units import CACHE_ENTRIES, SPACE, UnitCache, spaced_units, text_slices

#: The pre-tokens of byte-level BPE (fixed value of the vocabulary's format).
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixBpe:
    """Prefix tables of one byte-level BPE vocabulary."""

    def __init__(self, tokenizer_json: str):
        with open(tokenizer_json, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        raw = {name: bytes(alphabet[c] for c in name) for name in spec["model"]["vocab"]}
        ids = spec["model"]["vocab"]
        self.ids = {raw[name]: i for name, i in ids.items()}
        size = max(ids.values()) + 1
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.pairs: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = ids[a + b]
            self.pairs[ids[a] << 32 | ids[b]] = rank
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, ids[a], ids[b]
        self._stands: dict[int, bool] = {}
        #: Tokens whose bytes are encoded as themselves; no other can end a prefix.
        self.standing = {raw: token for raw, token in self.ids.items() if self.stands(token)}
        self.longest = max(map(len, self.standing))
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self._special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self._pretoken = regex.compile(PRETOKEN)
        self._seams: dict[int, bool] = {}
        self._words, self._plain, self._spaced = UnitCache(), UnitCache(), UnitCache()

    # ---- which tokens may follow each other ------------------------------------

    def _clean_seam(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b, encoded together, stay the tokens a and b.

        The merges are undone in descending rank. At each moment the two symbols at
        the seam must not have a merge that comes before the merge that changes one
        of them; at equal rank the merge further left comes first.
        """
        next_a = next_b = 1 << 62
        while True:
            rank = self.pairs.get(a << 32 | b)
            if rank is not None and rank < next_a and rank <= next_b:
                return False
            rank_a, rank_b = self.rank[a], self.rank[b]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                next_a, a = rank_a, self.right[a]
            else:
                next_b, b = rank_b, self.left[b]

    def stands(self, token: int) -> bool:
        """Whether the bytes of a token are encoded as that token."""
        known = self._stands.get(token)
        if known is None:
            if self.rank[token] < 0:
                known = True
            else:
                a, b, rank = self.left[token], self.right[token], self.rank[token]
                known = self.stands(a) and self.stands(b) and self._undisturbed(a, b, rank)
            self._stands[token] = known
        return known

    def _undisturbed(self, a: int, b: int, rank: int) -> bool:
        """As ``_clean_seam`` for the moments before the merge of a and b itself."""
        pair = a << 32 | b
        kept = self.pairs.pop(pair)
        try:
            return self._clean_seam(a, b)
        finally:
            self.pairs[pair] = kept

    def joins(self, last: int, token: int) -> bool:
        key = last << 32 | token
        known = self._seams.get(key)
        if known is None:
            if len(self._seams) >= CACHE_ENTRIES:
                self._seams.clear()
            known = self._seams[key] = self._clean_seam(last, token)
        return known

    # ---- prefix tables ------------------------------------------------------------

    def prefixes(self, word: bytes) -> list[int]:
        """Token count of word[:i] for every i, for one pre-token."""
        counts, last = [0], [-1]
        find, seam, longest = self.standing.get, self._seams.get, self.longest
        for end in range(1, len(word) + 1):
            # A longer prefix is no token; copying it would make a long word quadratic.
            token = find(word[:end]) if end <= longest else None
            if token is not None:
                counts.append(1)
                last.append(token)
                continue
            for start in range(max(1, end - longest), end):
                token = find(word[start:end])
                if token is None:
                    continue
                known = seam(last[start] << 32 | token)
                if known or known is None and self.joins(last[start], token):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts

    def _unit(self, unit: str) -> int:
        return sum(self.prefixes(word.encode())[-1] for word in self._pretoken.findall(unit))

    def _learn(self, units: set[str], cache: UnitCache, lead: str) -> None:
        """Counts of units not yet known, from the tables of their new words."""
        fresh = cache.missing(units)
        split = [self._pretoken.findall(lead + unit) for unit in fresh]
        words = self._words.missing(set(chain.from_iterable(split)))
        self._words.known.update((word, self.prefixes(word.encode())[-1]) for word in words)
        count = self._words.known.__getitem__
        cache.known.update((unit, sum(map(count, own))) for unit, own in zip(fresh, split))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts: the last entry of each prefix table."""
        totals, owner, sections = [0] * len(texts), [], []
        for i, text in enumerate(texts):
            parts = [text]
            if self._special is not None and any(name in text for name in self.special):
                parts = self._special.split(text)
                totals[i] = len(parts) - 1
            owner += [i] * len(parts)
            sections += map(spaced_units, parts)
        self._learn(set(chain.from_iterable(plain for plain, _ in sections)), self._plain, "")
        self._learn(set(chain.from_iterable(spaced for _, spaced in sections)), self._spaced, " ")
        of_plain, of_spaced = self._plain.known.__getitem__, self._spaced.known.__getitem__
        for i, (plain, spaced) in zip(owner, sections):
            totals[i] += sum(map(of_plain, plain)) + sum(map(of_spaced, spaced))
        return totals

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def table(self, text: str) -> list[int]:
        """Token count of text[:i] for every character position i.

        Inside a pre-token the word's own table answers. Where the cut changes the
        pre-tokens (white space at the end, a cut contraction) the few characters
        from the last firm boundary are split anew.
        """
        out = [0]
        start = 0
        for found in [*(self._special.finditer(text) if self._special else ()), None]:
            stop = found.start() if found else len(text)
            base = out[-1]
            out += [base + n for n in self._section(text[start:stop])[1:]]
            if found:
                token = found.group()
                # A cut special string is ordinary text that continues the section.
                tail = text[start:found.end() - 1]
                out += [base + self.count(tail[: stop - start + i]) for i in range(1, len(token))]
                out.append(base + self.count(text[start:stop]) + 1)
                start = found.end()
        return out

    def _section(self, text: str) -> list[int]:
        out, firm, firm_count, white_before = [0], 0, 0, False
        for found in self._pretoken.finditer(text):
            word, begin = found.group(), found.start()
            if not white_before:
                firm, firm_count = begin, out[-1]
            white = re.fullmatch(f"[{SPACE}]+", word) is not None
            if white or white_before or word[0] == "'":
                for end in range(begin + 1, found.end() + 1):
                    out.append(firm_count + self._unit(text[firm:end]))
            else:
                counts, at, base = self.prefixes(word.encode()), 0, out[begin]
                for char in word:
                    at += len(char.encode())
                    out.append(base + counts[at])
            white_before = white
        return out

    def longest_prefix(self, text: str, budget: int, table: list[int] | None = None) -> int:
        """Characters of the longest prefix from which on no shorter one exceeds ``budget`` tokens."""
        table = self.table(text) if table is None else table
        highest, most = [], 0
        for n in table:
            most = max(most, n)
            highest.append(most)
        return bisect_right(highest, budget) - 1


@lru_cache(maxsize=2)
def prefix_bpe(tokenizer_json: str) -> PrefixBpe:
    """One table of merges per Python worker."""
    return PrefixBpe(tokenizer_json)


def count_tokens(docs: DataFrame, tokenizer_json: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = prefix_bpe(tokenizer_json)
        for ids, texts in text_slices(batches):
            yield pa.record_batch({"id": pa.array(ids, pa.int64()), "n_tokens": pa.array(bpe.counts(texts), pa.int64()),
                                   "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64())})

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "id long, n_tokens long, n_bytes long")
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
