"""Every stage of the pipeline against a plain version of it, on its own input."""

import corpus_pipeline
import pytest
from diamondlake.llm.suffix_dedup import remove_repeats
from frames import document_rows, joined, repeated_bytes, repeated_words, shingles
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The odd documents of the other tests, some of them toxic, with labels."""
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in document_rows()]
    rows += [(1000 + i, f"clean words here {i} and more. " + ("you total zzscum. " if i % 3 == 0 else "fine. ") + f"closing {i}", "en", "s", 9) for i in range(240)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1000 + i, 1, int(i % 3 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "suffix_dedup", "packing"]
    toxicity, near, suffix, packing = (stage for _, stage in corpus_pipeline.STAGES)

    clean = toxicity(spark, docs, folder)
    assert clean.columns == docs.columns
    want = [r for r in docs.collect() if "zzscum" not in (r["text"] or "")]
    assert key(clean.collect()) == key(want)

    kept = near(spark, clean, folder)
    assert kept.columns == docs.columns
    rows = [r for r in clean.collect() if r["doc_id"] is not None]
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    ids = sorted(sets)
    group = joined(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
                         if (both := len(sets[a] & sets[b])) and 100 * both >= 75 * len(sets[a] | sets[b])])
    found = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in found if i is not None) == [i for i in ids if group[i] == i]
    assert sum(i is None for i in found) == clean.where("doc_id IS NULL").count()

    cut = suffix(spark, kept, folder)
    assert cut.columns == docs.columns
    before = kept.orderBy("doc_id", F.length("text")).collect()
    after = {(r["doc_id"], (r["text"] or "")): r["n_chars"] for r in cut.collect()}
    texts = [x["text"] for x in before]
    for r, spans, runs in zip(before, repeated_bytes(texts, 400), repeated_words(texts, 51)):
        raw = (r["text"] or "").encode()
        gone = {k for a, b in [*spans, *runs] for k in range(a, b)}
        raw = bytes(c for k, c in enumerate(raw) if k not in gone)
        assert (r["doc_id"], raw.decode("utf-8", "ignore")) in after

    pieces = packing(spark, cut, folder)
    assert pieces.select("doc_id").distinct().count() == cut.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, folder).agg(F.sum("length")).first()[0] == pieces.agg(F.sum("length")).first()[0]


def test_no_documents(spark, folder, tmp_path):
    """Every stage of an empty table, and the whole."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_ids(spark):
    """Texts of one id are judged apart: the copy goes, the other text stays; a link through the second text counts."""
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(5, words), (3, words + " more"), (5, "something else of that id entirely and quite different"), (1, "alone here"), (1, words + " again")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    assert {(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {rows[2], rows[3], rows[4]}


def key(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in rows)


def test_short_passages_of_many_words(spark):
    """Repeated runs of 51 words go, however short; 50 words, and two shorter repeats side by side, stay."""
    def words(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    tiny = " ".join("abcdefghijklmnopqrstuvwxyz"[i * i % 26] if i % 3 else "xy" for i in range(51))
    long, short, a, b = words("p", 53), words("q", 50), words("r", 30), words("s", 30)
    texts = [f"{x} {long} {y}" for x, y in (("one", "two"), ("three", "four"))]
    texts += [f"{x} {short} {y}" for x, y in (("five", "six"), ("seven", "eight"))]
    texts += [f"nine {a} {b} ten", f"eleven {a} twelve", f"thirteen {b} fourteen"]
    texts += [f"{x} {tiny} {y}" for x, y in (("left", "right"), ("up", "down"))]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in remove_repeats(docs, words=51).collect()}
    want = ["one  two", "three  four", *texts[2:7], "left  right", "up  down"]
    assert got == dict(enumerate(want))
