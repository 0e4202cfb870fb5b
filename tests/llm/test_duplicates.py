"""Near-duplicates and repeated passages against brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from frames import document_rows, documents, joined, lorem, repeated_bytes, shingles, similar_components

from diamondlake.llm import hyperminhash, suffix_dedup
from diamondlake.llm.byte_words import shingle_sets
from diamondlake.llm.components import components
from diamondlake.llm.hyperminhash import near_duplicates
from diamondlake.llm.suffix_dedup import HashedSuffixes, mark_repeats, remove_repeats, repeat_digests


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    frame = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(frame).collect()}
    ids = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == joined(ids, [p for p in pairs if p[0] != p[1]])
    assert components(frame.limit(0)).count() == 0


def test_shingles():
    texts = [t or "" for _, t in document_rows()]
    _, bounds = shingle_sets(texts)
    assert np.diff(bounds).tolist() == [len(shingles(t)) for t in texts]


def test_estimate():
    rng = random.Random(8)
    for share in (0.0, 0.5, 0.8):
        common = [lorem(rng, 400) for _ in range(1)][0].split()
        n = int(400 * share)
        texts = [" ".join(common[:n] + lorem(rng, 400 - n).split()) for _ in range(2)]
        value, bounds = shingle_sets(texts)
        regs = hyperminhash.registers(value, bounds)
        size = np.diff(bounds)
        exact = len(shingles(texts[0]) & shingles(texts[1])) / len(shingles(texts[0]) | shingles(texts[1]))
        assert abs(hyperminhash.estimate(regs, size, np.array([0]), np.array([1]))[0] - exact) < 0.2


@pytest.mark.parametrize("block", [256, 4])
def test_near_duplicates(spark, monkeypatch, block):
    """Blocks smaller than the groups give the same components."""
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    rows = document_rows()
    want = similar_components(rows)
    got = near_duplicates(documents(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (want[r["doc_id"]] == r["doc_id"])
    assert sorted(r["n_shingles"] for r in got) == sorted(len(shingles(t)) for _, t in rows)


def test_near_duplicates_empty(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert near_duplicates(documents(spark, [(1, None), (2, ""), (None, "a")])).where("kept").count() == 3


def test_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(12)]
    left, right = np.triu_indices(12, 1)
    want = [len(set(sets[a].tolist()) & set(sets[b].tolist())) for a, b in zip(left, right)]
    assert hyperminhash.intersections(sets, left, right, columns=7).tolist() == want
    assert hyperminhash.intersections(sets, left[:3], right[:3]).tolist() == want[:3]


def test_suffix_order():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 900).astype(np.uint8)
    data[300:500] = 97
    length = 40
    start = rng.permutation(len(data) - length)
    bucket = rng.integers(0, 5, len(start))
    order = HashedSuffixes(data, length).sort(start, bucket)
    got = [(bucket[i], data[start[i] : start[i] + length].tobytes()) for i in order]
    assert got == sorted(got) and sorted(order.tolist()) == list(range(len(start)))


@pytest.mark.parametrize("chunk", [8_192, 3])
def test_repeats(spark, monkeypatch, chunk):
    """Chunks smaller than the groups of contexts give the same spans."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rows = document_rows()
    spans = repeated_bytes([t for _, t in rows], 60)
    want = sorted((i is None, i or 0, len((t or "").encode()), sum(b - a for a, b in s), len(s), digest(t, s)) for (i, t), s in zip(rows, spans))
    marked = mark_repeats(documents(spark), length=60, gram=20)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeat_digests(marked).collect())
    assert got == want


def digest(text, spans):
    raw, at, out = (text or "").encode(), 0, b""
    for a, b in spans:
        out, at = out + raw[at:a], b
    return hashlib.sha256(out + raw[at:]).hexdigest()


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 2_000)
    rng = random.Random(6)
    passage = lorem(rng, 100)
    rows = [(1, lorem(rng, 900) + passage + lorem(rng, 300)), (2, passage + lorem(rng, 700) + passage[:450])]
    spans = repeated_bytes([t for _, t in rows], 60)
    got = {r["doc_id"]: [tuple(s) for s in r["spans"] or []] for r in mark_repeats(documents(spark, rows).drop("spans"), length=60, gram=20).collect()}
    assert got == {1: spans[0], 2: spans[1]}


def test_remove(spark):
    text = "é" * 300
    docs = documents(spark, [(1, "x" + text + "y"), (2, "p" + text + "qq"), (3, "clean"), (4, None)])
    got = {r["doc_id"]: r["text"] for r in remove_repeats(docs, length=400).collect()}
    assert got == {1: "xy", 2: "pqq", 3: "clean", 4: None}
    assert remove_repeats(docs, length=400).columns == docs.columns
    assert remove_repeats(documents(spark, []), length=400).count() == 0


@pytest.mark.parametrize("piece", [1_000_000, 130])
def test_runs_of_words(spark, monkeypatch, piece):
    """Word ranges against brute force, also in overlapping parts of a few words."""
    from frames import repeated_words

    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (19, 20, 21, 45, 90)]
    for i in range(60):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            at, one = rng.randint(0, len(own)), rng.choice(passages)
            own[at:at] = one[rng.randint(0, 5) : len(one) - rng.randint(0, 5)]
        rows.append((i, " ".join(own)))
    rows += [rows[3], (None, rows[5][1]), (200, None), (201, "")]
    marked = mark_repeats(documents(spark, rows), length=400, words=20)
    got = sorted((str(r["doc_id"]), r["text"] or "", [(s["start"], s["stop"]) for s in r["word_spans"] or ()]) for r in marked.collect())
    want = []
    for (i, text), ranges in zip(rows, repeated_words([t for _, t in rows], 20)):
        words = (text or "").encode().split()
        covered, at = [], 0
        starts = {}
        for k, w in enumerate(words):
            starts[(text.encode()).index(w, at)] = k
            at = text.encode().index(w, at) + len(w)
        for a, b in ranges:
            k = starts[a]
            if covered and k <= covered[-1][1]:
                covered[-1] = (covered[-1][0], k + 20)
            else:
                covered.append((k, k + 20))
        want.append((str(i), text or "", covered))
    assert got == sorted(want)


def test_memory_of_a_slice():
    """What a Python worker needs at once beside Spark's memory, however long the texts are."""
    text = " ".join(f"{i * 7919 % 99991:x}" for i in range(400_000))
    raw = np.frombuffer(text[: suffix_dedup.PIECE].encode(), dtype=np.uint8)
    for run in (
        lambda: suffix_dedup.anchors(raw, np.array([len(raw)]), 400, 100),
        lambda: shingle_sets([text[: hyperminhash.HASHED_CHARS]]),
    ):
        tracemalloc.start()
        run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60e6


def test_texts_that_move(spark, monkeypatch):
    """Texts without shared bucket stay where they are, and full sets are made of documents in open pairs only."""
    wanted = spark.range(0, 5_000, 50).selectExpr("id AS doc", "id * 7 AS text_key")
    rows = spark.range(5_000).selectExpr("id AS doc", "id * 7 AS text_key", "'x' AS text")
    kept = hyperminhash._maybe_in(rows, wanted, ["doc", "text_key"])
    assert kept.columns == rows.columns and kept.count() < 120
    assert kept.join(wanted, ["doc", "text_key"]).count() == 100
    monkeypatch.setattr(hyperminhash, "FILTER_BITS", 4)
    assert hyperminhash._maybe_in(rows, wanted, ["doc", "text_key"]).join(wanted, ["doc", "text_key"]).count() == 100

    asked = []
    plain = hyperminhash.set_rows
    monkeypatch.setattr(hyperminhash, "set_rows", lambda texts: (asked.append(texts.count()), plain(texts))[1])
    # Pairs of similarity 0.4: most agree in a band, none can be a link.
    dice = random.Random(8)
    words = [[f"w{dice.randrange(10**9)}" for _ in range(700)] for _ in range(12)]
    texts = [" ".join(w[k : k + 230] + w[300 + 170 * k : 470 + 170 * k]) for w in words for k in (0, 0, 1)]
    texts = [t for i, t in enumerate(texts) if i % 3 != 1] + [" ".join(w[:230] + w[300:469]) for w in words[:2]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(docs).collect()}
    assert sum(i != c for i, c in got.items()) == 2 and got[24] == 0 and got[25] == 2
    assert asked and sum(asked) <= 4
