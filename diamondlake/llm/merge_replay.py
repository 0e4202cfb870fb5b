"""Byte-level BPE by replaying the merges over all distinct words of a slice of the corpus.

The distinct words of a slice lie in one array of symbols. An inverted index holds,
for every token that a neighbouring pair can form, the places of such pairs. Tokens
are taken in rank order; all places of a token are merged at once, and only the two
neighbours of a merged pair enter the index anew. The slice's texts are then put
together from the words' ids.

A pair that could form a token of lower rank than the one in turn (possible where a
part of a token was learnt later than the token) is encoded word by word instead,
so results are those of the usual greedy order in every case.

Defined results: a NULL or empty text has no ids and decodes to no bytes; no text is
special; unknown ids cannot arise, as all 256 bytes are tokens; a row that occurs twice is
encoded twice, alike; a text of any length is encoded whole, as a slice of its own; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.text_units import UnitCache, spaced_units, text_slices

REPLAY_WORDS = 50_000


class MergeReplay:
    """Encoder and decoder for a file of base64 tokens and ranks, cut by a pattern."""

    def __init__(self, ranks_file: str, pattern: str):
        with open(ranks_file, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = rank
        self.first = np.full((256, 256), -1, dtype=np.int64)
        for a in range(256):
            for b in range(256):
                self.first[a, b] = self.pairs.get(int(self.byte_ids[a]) << 32 | int(self.byte_ids[b]), -1)
        tokens = sorted(self.ranks, key=self.ranks.get)
        places = np.array([self.ranks[t] for t in tokens])
        self.length = np.zeros(places.max() + 1, dtype=np.int64)
        self.length[places] = [len(t) for t in tokens]
        self.start = np.zeros(places.max() + 1, dtype=np.int64)
        self.start[places] = np.cumsum([0, *map(len, tokens[:-1])])
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self._words, self._plain, self._spaced = UnitCache(), UnitCache(), UnitCache()
        self.out_of_order = 0

    # ---- words -------------------------------------------------------------------

    def greedy(self, word: bytes) -> list[int]:
        """One word by the usual order: lowest rank first, leftmost first."""
        ids = [int(self.byte_ids[b]) for b in word]
        while True:
            found = [(self.pairs[k], i) for i in range(len(ids) - 1) if (k := ids[i] << 32 | ids[i + 1]) in self.pairs]
            if not found:
                return ids
            rank, at = min(found)
            ids[at : at + 2] = [rank]

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word, packed as little-endian unsigned 32-bit integers."""
        ends = np.cumsum([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        size = len(flat)
        last = np.zeros(size, dtype=bool)
        last[ends - 1] = True
        token = self.first[flat[:-1], flat[1:]] if size > 1 else np.zeros(0, dtype=np.int64)
        token[last[:-1]] = -1
        places = np.flatnonzero(token >= 0)
        places = places[np.argsort(token[places], kind="stable")]
        index: dict[int, list[int]] = defaultdict(list)
        found, first = np.unique(token[places], return_index=True)
        for rank, at in zip(found.tolist(), np.split(places, first[1:])):
            index[rank] = at.tolist()
        symbol = self.byte_ids[flat].tolist()
        after = np.where(last, -1, np.arange(1, size + 1)).tolist()
        before = np.where(np.concatenate(([True], last[:-1])), -1, np.arange(-1, size - 1)).tolist()
        heap, pairs, odd = list(index), self.pairs, set()
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            here = index.pop(rank)
            here.sort()
            for p in here:
                a, q = symbol[p], after[p]
                if a < 0 or q < 0 or pairs.get(a << 32 | symbol[q]) != rank:
                    continue
                symbol[p], symbol[q] = rank, -1
                r, left = after[q], before[p]
                after[p] = r
                if r >= 0:
                    before[r] = p
                    formed = pairs.get(rank << 32 | symbol[r])
                    if formed is not None:
                        if formed <= rank:
                            odd.add(p)
                        elif formed in index:
                            index[formed].append(p)
                        else:
                            index[formed] = [p]
                            heapq.heappush(heap, formed)
                if left >= 0:
                    formed = pairs.get(symbol[left] << 32 | rank)
                    if formed is not None:
                        if formed <= rank:
                            odd.add(p)
                        elif formed in index:
                            index[formed].append(left)
                        else:
                            index[formed] = [left]
                            heapq.heappush(heap, formed)
        ids = np.array(symbol, dtype=np.int64)
        alive = ids >= 0
        bounds = (4 * np.cumsum(alive)[ends - 1]).tolist()
        packed = ids[alive].astype("<u4").tobytes()
        out = [packed[a:b] for a, b in zip([0, *bounds], bounds)]
        limits = ends.tolist()
        for word in {bisect_right(limits, p) for p in odd}:
            self.out_of_order += 1
            out[word] = np.array(self.greedy(words[word]), dtype="<u4").tobytes()
        return out

    # ---- texts ----------------------------------------------------------------------

    def _learn(self, units: set[str], cache: UnitCache, lead: str) -> None:
        """Ids of units not yet known, by one replay over their new words."""
        fresh = cache.missing(units)
        split = [self.pattern.findall(lead + unit) for unit in fresh]
        words = self._words.missing(set(chain.from_iterable(split)))
        raw = [w.encode() for w in words]
        whole = [self.ranks.get(w) for w in raw]
        known = self._words.known
        known.update((w, r.to_bytes(4, "little")) for w, r in zip(words, whole) if r is not None)
        open_words = [(w, b) for w, b, r in zip(words, raw, whole) if r is None]
        for at in range(0, len(open_words), REPLAY_WORDS):
            part = open_words[at : at + REPLAY_WORDS]
            known.update(zip((w for w, _ in part), self.replay([b for _, b in part])))
        ids = known.__getitem__
        cache.known.update((unit, b"".join(map(ids, own))) for unit, own in zip(fresh, split))

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, packed as little-endian unsigned 32-bit integers."""
        units = [spaced_units(t) for t in texts]
        self._learn(set(chain.from_iterable(plain for plain, _ in units)), self._plain, "")
        self._learn(set(chain.from_iterable(spaced for _, spaced in units)), self._spaced, " ")
        plain_ids, spaced_ids = self._plain.known.__getitem__, self._spaced.known.__getitem__
        return [b"".join(map(plain_ids, plain)) + b"".join(map(spaced_ids, spaced)) for plain, spaced in units]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed([text])[0], dtype="<u4").tolist()

    def decode_packed(self, packed: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        ids = np.frombuffer(packed, dtype="<u4")
        length = self.length[ids]
        shift = self.start[ids] - (np.cumsum(length) - length)
        return self.flat[np.repeat(shift, length) + np.arange(length.sum())].tobytes()


@lru_cache(maxsize=2)
def merge_replay(ranks_file: str, pattern: str) -> MergeReplay:
    """One encoder per Python worker."""
    return MergeReplay(ranks_file, pattern)


def encode_documents(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (array of int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = merge_replay(ranks_file, pattern)
        for keys, texts in text_slices(batches):
            packed = coder.encode_packed(texts)
            bounds = np.cumsum([0, *(len(p) // 4 for p in packed)])
            flat = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
            yield pa.record_batch({"id": pa.array(keys, pa.int64()), "ids": lists})

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "id long, ids array<int>")
    return rows.select(F.col("id").alias(id_col), "ids")


def round_trip(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = merge_replay(ranks_file, pattern)
        for keys, texts in text_slices(batches):
            packed = coder.encode_packed(texts)
            yield pa.record_batch({
                "id": pa.array(keys, pa.int64()), "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                "decoded_sha256": [hashlib.sha256(coder.decode_packed(p)).hexdigest() for p in packed],
            })

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema).withColumnRenamed("id", id_col)
