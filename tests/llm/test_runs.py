"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from frames import document_rows, documents

from diamondlake.llm import grammar_runs, queries
from diamondlake.llm.grammar_runs import find_runs, numbered, word_runs


def brute_runs(words, least=6, repeats=4):
    """(start, length, period) of every run, by trying every period."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, repeats * q) and i > start:
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in drop)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed):
    """Short alphabets, nested powers, cut powers, whole blocks copied within a text."""
    rng = random.Random(seed)
    for _ in range(25):
        texts = []
        for _ in range(30):
            k = rng.choice([1, 2, 3, 5, 50])
            w = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
            for _ in range(rng.randint(0, 4)):
                u = [rng.randrange(k) for _ in range(rng.randint(1, 12))]
                w = w[: rng.randint(0, len(w))] + (u * rng.randint(2, 9))[: rng.randint(1, 80)] + w[rng.randint(0, len(w)) :]
            kind = rng.randrange(4)
            w = [w, w * 4, w + [999] + w + [998] + w, (w * 6)[: rng.randint(1, 300)]][kind]
            texts.append([str(x).encode() for x in w])
        start, length, period = word_runs(*numbered(texts))
        bounds = np.cumsum([0, *map(len, texts)])
        got = [[] for _ in texts]
        for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
            of = int(np.searchsorted(bounds, s, side="right")) - 1
            got[of].append((s - int(bounds[of]), n, q))
        assert got == [brute_runs(t) for t in texts]


def test_long_powers():
    """Tens of thousands of words in one run, of a long and of the shortest period."""
    u = np.random.default_rng(5).integers(0, 500, 9_001)
    start, length, period = word_runs(np.tile(u, 5), np.zeros(45_005, dtype=np.int64))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [45_005], [9_001])
    start, length, period = word_runs(np.zeros(50_000, dtype=np.int64), np.zeros(50_000, dtype=np.int64))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [50_000], [1])


def test_grammar_expands_to_the_words():
    """Every symbol has one expansion at all its places, and no pair of the final sequence repeats."""
    words = np.array([1, 2, 1, 2, 3, 1, 2, 3, 9, 9, 9, 9, 9, 9, 9, 4, 1, 2, 3])
    grammar = grammar_runs.repair(words, np.zeros(len(words), dtype=np.int64))
    for k in range(len(grammar.size)):
        at = grammar.place[grammar.symbol == k]
        assert len(at) > 1 and len({tuple(words[p : p + grammar.size[k]]) for p in at.tolist()}) == 1
    with pytest.raises(ValueError):
        word_runs(words, np.zeros(len(words), dtype=np.int64), least=6, repeats=3)


def odd_rows():
    rows = document_rows()
    rng = random.Random(9)
    for i in range(60):
        u = [rng.choice(["a", "b", "É", "ß."]) for _ in range(rng.randint(1, 9))]
        rows.append((2000 + i, "  ".join(["x", "y"][: i % 3] + u * rng.randint(3, 8) + ["z"])))
    rows.append((3000, "long " + "alpha beta gamma " * 9_000))
    return rows


@pytest.mark.parametrize("chars", [3_000_000, 2_000])
def test_operator(spark, monkeypatch, chars):
    """All odd documents, in slices of many and of one text; columns with clashing names."""
    monkeypatch.setattr(grammar_runs, "SLICE_CHARS", chars)
    rows = odd_rows()
    got = sorted((r["doc_id"] or -1, r["collapsed"], [tuple(x) for x in r["runs"]]) for r in find_runs(documents(spark, rows)).collect())
    want = []
    for i, text in rows:
        runs = brute_runs(words_of(text)) if len(text or "") < 90_000 else [(1, 27_000, 3)]
        want.append((i or -1, collapsed(words_of(text), runs), runs))
    assert got == sorted(want)
    assert find_runs(documents(spark, [])).count() == 0


def digest(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), collapsed(words, runs))]
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], *sha)


def test_query(spark, small):
    """The registered query over the whole table, every document by brute force."""
    got = queries.QUERIES["op12_grammar_runs"](spark, small).collect()
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(digest(r["doc_id"], r["text"]) for r in docs)
    assert any(r["n_runs"] for r in got)
