"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a logistic score over the words and
word beginnings in it; the document's probability is the noisy-or of its sentences,
1 - prod(1 - p). Only document labels are known in training: the gradient of the bag
goes to the sentences that explain it, so the model also points out which ones offend.

Training: words and word beginnings of a bounded sample of labelled documents are
counted by label in Spark, those whose document frequency differs clearly between the
labels become features, and the bags, reduced to those features, are fitted by
full-batch gradient steps. The scores are computed over every document in its own task.

Defined results: a NULL or empty text has no sentence and score 0; rows without a
label, or with a NULL id, are not learnt from; without a toxic label all scores are 0.
A document that occurs twice is scored twice, alike; a text of any length is scored whole;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, expm1, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.text_units import text_slices
from diamondlake.operators.materialize import materialize

#: Bounds of what is fitted on: documents in the sample, and features.
SAMPLE_DOCUMENTS = 20_000
FEATURES = 8_192
#: Lengths of the word beginnings that count as features, besides whole words.
BEGINNINGS = (3, 4, 5, 6)
_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def sentences(text: str) -> list[tuple[int, str]]:
    """(start, sentence) of every part between sentence marks that holds a word."""
    out, start = [], 0
    for mark in [*_SENTENCE.finditer(text), None]:
        stop = mark.start() if mark else len(text)
        if stop > start and _WORD.search(text, start, stop):
            out.append((start, text[start:stop]))
        start = mark.end() if mark else stop
    return out


def word_features(word: str) -> list[str]:
    """A word and its beginnings; a beginning carries a mark so that it is no word."""
    return [word, *(word[:n] + "~" for n in BEGINNINGS if len(word) >= n)]


@dataclass
class Model:
    """Feature weights and bias of a sentence."""

    weights: dict[str, float]
    bias: float
    cache: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def word(self, word: str) -> float:
        known = self.cache.get(word)
        if known is None:
            if len(self.cache) > 300_000:
                self.cache.clear()
            get = self.weights.get
            known = self.cache[word] = sum(get(f, 0.0) for f in word_features(word))
        return known

    def sentence_scores(self, text: str) -> list[tuple[int, str, float]]:
        """(start, sentence, probability) of every sentence."""
        out = []
        for start, sentence in sentences(text):
            z = self.bias + sum(map(self.word, set(_WORD.findall(sentence.lower()))))
            out.append((start, sentence, 1.0 / (1.0 + np.exp(-max(-30.0, min(30.0, z))))))
        return out

    def score(self, text: str) -> float:
        """Noisy-or of the sentences."""
        words, cache, get = _WORD.findall, self.cache, self.cache.get
        log_rest = 0.0
        for sentence in _SENTENCE.split(text.lower()):
            found = set(words(sentence))
            if not found:
                continue
            z = self.bias
            for word in found:
                value = get(word)
                z += self.word(word) if value is None else value
            log_rest += log1p(exp(z)) if z < 30.0 else z
        return -expm1(-log_rest)


def _feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): documents of the sample with the feature, by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for labels, texts in text_slices(batches):
            for label, text in zip(labels, texts):
                found: set[str] = set()
                for word in set(_WORD.findall(text.lower())):
                    found.update(word_features(word))
                counts[label].update(found)
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield _counted(counts)
                counts = (Counter(), Counter())
        yield _counted(counts)

    def _counted(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        return pa.record_batch({"feature": pa.array(names, pa.string()), "toxic": pa.array([counts[1][f] for f in names], pa.int64()),
                                "clean": pa.array([counts[0][f] for f in names], pa.int64())})

    rows = sample.select("label", "text").mapInArrow(run, "feature string, toxic long, clean long")
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _bags(sample: DataFrame, features: dict[str, int]) -> DataFrame:
    """One row per document: label, sentences, and (sentence, feature) pairs of known features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, texts in text_slices(batches):
            n, where, what = [], [], []
            for text in texts:
                places, known = [], []
                bag = [set(_WORD.findall(s)) for s in _SENTENCE.split(text.lower())]
                bag = [words for words in bag if words]
                for at, words in enumerate(bag):
                    own = [features[f] for w in words for f in word_features(w) if f in features]
                    known += own
                    places += [at] * len(own)
                n.append(len(bag))
                where.append(places)
                what.append(known)
            yield pa.record_batch({"label": pa.array(labels, pa.int64()), "n": pa.array(n, pa.int64()),
                                   "at": pa.array(where, pa.list_(pa.int32())), "feature": pa.array(what, pa.list_(pa.int32()))})

    return sample.select("label", "text").mapInArrow(run, "label long, n long, at array<int>, feature array<int>")


def _noisy_or_fit(bags: pa.Table, n_features: int, steps: int, rate: float, ridge: float) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the mean log loss of the bags; sentences without a feature share the bias."""
    label = bags["label"].to_numpy().astype(float)
    n = bags["n"].to_numpy()
    first = np.concatenate(([0], np.cumsum(n)))
    bag_of = np.repeat(np.arange(len(n)), n)
    at, what = bags["at"].combine_chunks(), bags["feature"].combine_chunks()
    sizes = np.asarray(at.value_lengths())
    row = np.repeat(first[:-1], sizes) + np.asarray(at.flatten())
    column = np.asarray(what.flatten())
    theta, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    theta[-1] = -4.0
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(row, weights=theta[column], minlength=len(bag_of))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        rest = np.bincount(bag_of, weights=np.logaddexp(0, z), minlength=len(n))
        bag_p = np.clip(-np.expm1(-rest), 1e-12, 1 - 1e-12)
        pull = np.where(label > 0, -(1 - bag_p) / bag_p, 1.0) / len(n)
        grad_z = pull[bag_of] * p
        grad = np.append(np.bincount(column, weights=grad_z[row], minlength=n_features), grad_z.sum())
        grad[:-1] += ridge * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def fit(
    docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, max_features: int = FEATURES,
    least_documents: int = 4, least_z: float = 4.0, steps: int = 300, rate: float = 0.1, ridge: float = 1e-5,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Model:
    """Learn from the texts of labelled documents.

    About ``sample_documents`` labels at most, those with the smallest hashes of
    their ids, are kept before they meet the texts; that bound makes them small
    enough to be sent to every task. A document with several labels counts as toxic
    if any of them says so.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("long").alias("label"))
    part = min(1.0, sample_documents / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(part * (1 << 20)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = materialize(texts.join(F.broadcast(known), "id").select("label", "text"))
    totals = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic:
        return Model({}, -30.0)
    seen = F.col("toxic") + F.col("clean")
    expected = seen * (toxic / (toxic + clean))
    z = (F.col("toxic") - expected) / F.sqrt(expected * (1 - toxic / (toxic + clean + 1)))
    best = _feature_counts(chosen).where(seen >= least_documents).select("feature", z.alias("z"))
    best = best.where(F.abs("z") >= least_z).orderBy(F.abs("z").desc(), "feature").limit(max_features)
    names = [r["feature"] for r in best.collect()]
    if not names:
        return Model({}, -30.0)
    bags = _bags(chosen, {name: i for i, name in enumerate(names)}).toArrow()
    theta, bias = _noisy_or_fit(bags, len(names), steps, rate, ridge)
    return Model({name: float(w) for name, w in zip(names, theta) if abs(w) > 1e-6}, bias)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score (0 to 1)."""
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, bias)
        for ids, texts in text_slices(batches):
            yield pa.record_batch({"id": pa.array(ids, pa.int64()), "score": pa.array([own.score(t) for t in texts], pa.float64())})

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "id long, score double")
    return rows.withColumnRenamed("id", id_col)


def keep_below(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``."""
    weights, bias, at = model.weights, model.bias, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, bias)
        for batch in batches:
            yield batch.filter(pa.array([own.score(text or "") < threshold for text in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def offending_sentences(
    docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per sentence whose own probability reaches ``threshold``: id, start, sentence, score."""
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, bias)
        for ids, texts in text_slices(batches):
            rows = [(key, *found) for key, text in zip(ids, texts) for found in own.sentence_scores(text) if found[2] >= threshold]
            ids_, starts, parts, scores = zip(*rows) if rows else ((), (), (), ())
            yield pa.record_batch({"id": pa.array(ids_, pa.int64()), "start": pa.array(starts, pa.int64()),
                                   "sentence": pa.array(parts, pa.string()), "score": pa.array(scores, pa.float64())})

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "id long, start long, sentence string, score double")
    return rows.withColumnRenamed("id", id_col)


def held_out(id_column: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text falls into the fold that is never learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == fold, F.lit(False))
