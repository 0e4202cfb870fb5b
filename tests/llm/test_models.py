"""Toxicity on held-out documents; the language model against plain counts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from frames import document_rows, documents, lorem
from pyspark.sql import functions as F

from diamondlake.llm import brown_lm, mil_toxicity


def test_coded_words():
    """The words of many texts at once are those of one text after the other."""
    rng = random.Random(2)
    for _ in range(200):
        texts = ["".join(rng.choices("aAbBÉé \t\n\x0b\x0c\r\x1c\x1f\x85\xa0İ日", k=rng.randint(0, 12))) for _ in range(rng.randint(0, 6))]
        words, code, size = brown_lm.coded(texts)
        assert words.take(code).to_pylist() == [w for t in texts for w in brown_lm.tokens(t)]
        assert size.tolist() == [len(brown_lm.tokens(t)) for t in texts] and words[-1].as_py() == brown_lm.END


def test_words_by_columns():
    """Units of all words at once are those of one word after the other; words of one and two bytes and none included."""
    own = [brown_lm.END, b"a", b"the", "é".encode()]
    listed = [b"", b"a", b"b", b"ab", b"the", b"bathe", "é".encode(), "né".encode(), b"b", b" ", b"\xff"]
    one = brown_lm.UnitOf(own)
    got = brown_lm.unit_places(pa.array(listed, pa.binary()).slice(1), pa.array(own, pa.binary()))
    assert got.tolist() == [one[w] for w in listed[1:]]
    assert brown_lm.unit_places(pa.array([], pa.binary()), pa.array(own, pa.binary())).tolist() == []


def test_whole_words():
    """However sorted rows fall into batches, a word's rows come in one batch, all of them once."""
    rng = random.Random(4)
    for _ in range(100):
        rows = sorted(rng.choices([b"a", b"b", b"c", b"dd", b"e"], k=rng.randint(0, 20)))
        batches, at = [], 0
        while at < len(rows):
            step = rng.randint(0, 6)
            batches.append(pa.record_batch({"word": pa.array(rows[at : at + step], pa.binary()), "i": pa.array(range(at, min(at + step, len(rows))), pa.int64())}))
            at += step
        got = [b.to_pydict() for b in brown_lm.whole_words(iter(batches), rows=rng.randint(1, 4))]
        assert [w for g in got for w in g["word"]] == rows and [i for g in got for i in g["i"]] == list(range(len(rows)))
        assert all(a["word"][-1] != b["word"][0] for a, b in zip(got, got[1:]))


def test_contexts_are_sorted_not_collected(spark):
    """A word's contexts meet by one sort; collecting them in tasks first sorted all rows a second time to no avail."""
    docs = documents(spark, [(1, "a b a"), (2, "b c")])
    kind = np.arange(1 + brown_lm.ENDINGS) % 2
    contexts = brown_lm.first_contexts(docs, [brown_lm.END], kind, 2)
    found = brown_lm.moved(contexts, np.full((2, 2), 3.0), kind[1:], 0.0)
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r["word"], r["n"]) for r in found.collect()} == {(b"a", 2), (b"b", 2), (b"c", 1)}


def labelled_rows(n=600, seed=3):
    """Documents of some sentences; the toxic ones have one with a word of a small list or a bad beginning."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        parts = [lorem(rng, rng.randint(4, 12)) for _ in range(rng.randint(1, 6))]
        toxic = i % 5 == 0
        if toxic:
            parts[rng.randrange(len(parts))] += " " + rng.choice(["zzbad", "yyugly", "qqvile" + lorem(rng, 1)])
        rows.append((i, ". ".join(parts) + ".", int(toxic)))
    return rows


def test_held_out_documents(spark):
    rows = labelled_rows()
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = mil_toxicity.fit(docs, labels.where(~mil_toxicity.held_out(F.col("doc_id"))))
    toxic = {i: y for i, _, y in rows}
    scored = mil_toxicity.score_documents(docs, model).collect()
    out = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(out) > 100 and sum((r["score"] >= 0.3) == toxic[r["doc_id"]] for r in out) / len(out) > 0.97
    # The sentence that made the document toxic is found.
    found = mil_toxicity.offending_sentences(docs, model).collect()
    hits = [r for r in found if toxic[r["doc_id"]]]
    assert len(hits) > 100 and all(any(w in r["sentence"] for w in ("zzbad", "yyugly", "qqvile")) for r in hits)
    texts = {i: t for i, t, _ in rows}
    assert all(texts[r["doc_id"]][r["start"] :].startswith(r["sentence"]) for r in found)
    kept = mil_toxicity.keep_below(docs, model).collect()
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in scored if r["score"] < 0.3}


def test_scores_are_noisy_or():
    model = mil_toxicity.Model({"bad": 3.0, "bad~": 1.0, "good": -2.0}, -1.0)
    text = "Bad thing! good one.\n?? bad good"
    parts = [p for _, _, p in model.sentence_scores(text)]
    assert len(parts) == 3 and abs(model.score(text) - (1 - math.prod(1 - p for p in parts))) < 1e-12
    assert model.score("") == model.score("...") == 0.0


def test_odd_documents(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = mil_toxicity.score_documents(docs, mil_toxicity.fit(docs, none)).collect()
    assert len(scored) == len(document_rows()) and all(0 <= r["score"] < 1e-6 for r in scored)
    model = mil_toxicity.Model({"a": 1.0}, -2.0)
    assert mil_toxicity.score_documents(documents(spark, []), model).count() == 0


def _tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in lower.encode().decode().split(" ") for w in w.replace("\t", " ").replace("\n", " ").split(" ") if w] + [brown_lm.END]


def test_language_model(spark, monkeypatch):
    """Base scores as counted plainly, rare words by way of the join included; the model is a distribution."""
    rows = document_rows()
    train_rows = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 != 1]
    docs = documents(spark)
    model = brown_lm.train(docs.where(~brown_lm.held_out(F.col("doc_id"))), classes=8, frequent=50, head=60)
    counts = Counter(w for _, t in train_rows for w in brown_lm.tokens(t or ""))
    total, words = sum(counts.values()), len(counts)
    assert (model.train_tokens, model.train_words) == (total, words)
    unit_of = brown_lm.UnitOf(model.frequent)
    kind = {w: model.kind[unit_of[w]] for w in counts}
    assert np.allclose(np.bincount([kind[w] for w in counts], minlength=8), model.class_words)
    assert np.allclose(np.bincount([kind[w] for w in counts], weights=list(counts.values()), minlength=8), model.class_tokens)
    assert np.allclose((10**model.transition).sum(1), 1)
    got = {(r["doc_id"], r["n_tokens"], r["n_known"]): r for r in brown_lm.score(docs, model).collect()}
    assert len(brown_lm.score(docs, model).collect()) == len(rows)
    for i, text in rows:
        own = brown_lm.tokens(text or "")
        r = got[i, len(own), sum(counts[w] > 0 for w in own)]
        if i is None:
            continue
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (words + 1))) for w in own), rel_tol=1e-9)
        before, value = model.kind[0], 0.0
        for w in own:
            k = model.kind[unit_of[w]]
            value += model.transition[before, k] + math.log10((counts[w] + 0.5) / (model.class_tokens[k] + 0.5 * (model.class_words[k] + 1)))
            before = k
        assert math.isclose(r["score"], value, rel_tol=1e-9)


def test_exchange():
    """Units of two alternating kinds are told apart, and no single move raises the likelihood."""
    rng = np.random.default_rng(5)
    bigrams = rng.integers(0, 3, (20, 20)).astype(float)
    bigrams[:10, 10:] += 40
    bigrams[10:, :10] += 40
    kind = brown_lm.exchange(bigrams, 2)
    assert len(set(kind[:10])) == len(set(kind[10:])) == 1 and kind[0] != kind[10]

    def likelihood(kind, classes):
        member = np.eye(classes)[kind]
        table = member.T @ bigrams @ member
        return brown_lm._h(table).sum() - brown_lm._h(table.sum(0)).sum() - brown_lm._h(table.sum(1)).sum()

    bigrams = rng.integers(0, 9, (30, 30)).astype(float)
    kind = brown_lm.exchange(bigrams, 4, sweeps=60)
    best = likelihood(kind, 4)
    for u in range(30):
        for k in range(4):
            other = kind.copy()
            other[u] = k
            assert likelihood(other, 4) <= best + 1e-6


def test_language_model_empty(spark):
    model = brown_lm.train(documents(spark, []))
    r = brown_lm.score(documents(spark, [(1, "a b"), (2, None)]), model).collect()
    assert sorted((x["doc_id"], x["n_tokens"], x["n_known"], x["base_score"]) for x in r) == [(1, 3, 0, 0.0), (2, 1, 0, 0.0)]


def test_rare_words_have_own_classes(spark):
    """Words of one ending and two uses are told apart, inside and outside the head; class bigrams cover every token."""
    rows, made = [], []
    for i in range(60):
        made += [f"n{i}xy", f"v{i}xy"]
        rows += [f"the n{i}xy of the n{i}xy of", f"we v{i}xy to we v{i}xy to", f"the n{i}xy of we v{i}xy to"]
        rows += ["the thing of the thing of", "we run to we run to"] * 3
    model = brown_lm.train(documents(spark, list(enumerate(rows))), classes=8, frequent=7, head=30, stay=0.0)
    kinds = {r["word"]: r["kind"] for r in model.counts.collect()}
    assert len(kinds) == len(made) + 6
    nouns, verbs = ({kinds[w.encode()] for w in made if w[0] == c} for c in "nv")
    assert not nouns & verbs
    table, classes = np.zeros((8, 8)), {**kinds, brown_lm.END: model.kind[0]}
    for text in rows:
        own = [brown_lm.END, *brown_lm.tokens(text)]
        for a, b in zip(own, own[1:]):
            table[classes[a], classes[b]] += 1
    assert np.allclose(model.class_tokens, table.sum(0))
    share = (table.sum(0) + 1) / (table.sum() + 8)
    assert np.allclose(10**model.transition, (table + 5 * share) / (table.sum(1, keepdims=True) + 5))
