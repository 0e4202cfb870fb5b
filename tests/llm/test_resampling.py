"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from frames import documents, document_rows, lorem

from diamondlake.llm import gain_table, queries
from diamondlake.llm.gain_table import Lanes, SlotTable, features, resample, same_bytes, xxhash64


def test_hash():
    """The library's 64-bit xxhash, for every length up to some hundred bytes."""
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 20_000, dtype=np.uint8).tobytes()
    start = rng.integers(0, 19_000, 700)
    size = np.concatenate((np.arange(200), rng.integers(1, 700, 500)))
    got = xxhash64(Lanes(data), start, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a : a + b]) for a, b in zip(start.tolist(), size.tolist())]


def test_byte_comparison():
    data = b"abcdefghijklmnop" * 4 + b"abcdefghijklmnoX"
    x, y = np.array([0, 0, 0, 0]), np.array([16, 64, 64, 64])
    size = np.array([40, 16, 15, 8])
    assert same_bytes(Lanes(data), x, y, size).tolist() == [True, False, True, True]


def plain_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("collide", [False, True])
def test_interning(monkeypatch, collide):
    """Counts by bytes, also where all hashes fall together."""
    if collide:
        monkeypatch.setattr(gain_table, "xxhash64", lambda lanes, start, size: np.full(len(start), np.uint64(7)))
    texts = ["a bb a CC-bb é é٣", "", "dd " * 5, "x" * 70 + " " + "x" * 70 + " " + "x" * 69 + "y"]
    found = features(texts, 2)
    table = SlotTable(found, 1 << 30)
    got = Counter()
    for k, slot in enumerate(table.slot.tolist()):
        got[slot, found.data[found.start[k] : found.start[k] + found.size[k]]] += 1
    want = Counter(f.encode() for t in texts for f in plain_features(t, 2)[1])
    assert Counter({name: n for (_, name), n in got.items()}) == want and len(got) == len(want)
    assert all(table.count[slot] == n and table.bucket[slot] == zlib.crc32(name) % (1 << 30) for (slot, name), n in got.items())


def plain_resample(rows, target, longest=1, buckets=10_000, share=10, least=20, seed=2024):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t, longest)[1])

    s, t = counts(x for _, x in rows), counts(target)
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out, eligible = [], []
    for i, text in rows:
        words, feats = plain_features(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in feats) // len(feats) if feats else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words) >= least:
                eligible.append((-score, i))
        out.append((i, len(feats), weight, score))
    return sorted(out, key=str), sorted(eligible)[: share * len(eligible) // 100]


@pytest.mark.parametrize("longest, buckets, chars", [(1, 10_000, 2_000_000), (3, 50, 1_500)])
def test_operator(spark, monkeypatch, longest, buckets, chars):
    """Odd documents with NULL ids and repeated rows; few buckets, longer features, small slices."""
    monkeypatch.setattr(gain_table, "SLICE_CHARS", chars)
    rng = random.Random(2)
    rows = document_rows() + [(500 + i, lorem(rng, 40)) for i in range(150)]
    target = [lorem(rng, 30) for _ in range(20)] + [None, ""]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample(documents(spark, rows), frame, longest, buckets, share=30).collect()
    want, drawn = plain_resample(rows, target, longest, buckets, share=30)
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got), key=str) == want
    ranked = sorted((r["rank"], -r["score"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert ranked == [(k + 1, *d) for k, d in enumerate(drawn)] and len(ranked) > 20


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "one two")], none.schema)
    assert resample(none, some).count() == 0
    (row,) = resample(some, none).collect()
    assert row["rank"] is None and row["n_features"] == 2
    (row,) = resample(some, some, least_words=1, share=100).collect()
    assert row["rank"] == 1


def test_query(spark, small):
    """The registered query over the whole tables."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = queries.QUERIES["op13_gain_resampling"](spark, small).collect()
    want, drawn = plain_resample(docs, target)
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got), key=str) == want
    assert sorted((r["rank"], -r["score"], r["doc_id"]) for r in got if r["rank"]) == [(k + 1, *d) for k, d in enumerate(drawn)]
