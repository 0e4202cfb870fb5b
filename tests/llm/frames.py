"""Small tables with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # Names that operators use for their own columns.
    *[T.StructField(name, T.StringType()) for name in ("id", "n", "component", "key", "score", "spans", "k1")],
])
ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "One two  three\tfour", "a b c d e", "a b c d e f", "A b C d e F",
    "it's we'll 're x<|endoftext|> y <|endof", "naïve café ½ ٣٤ 你好 x\x1c!\x1c ἈΣ İ é", "aaaa" * 300, "z " * 900,
]


def lorem(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def document_rows(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Odd texts, copies, near copies, shared passages, a very long text, a repeated row, rows without id."""
    rng = random.Random(seed)
    rows = list(enumerate(ODD_TEXTS))
    base = lorem(rng, 160).split()
    for _ in range(40):
        words = base[:]
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = lorem(rng, 1)
        rows.append((len(rows), " ".join(words)))
    passage = lorem(rng, 120)
    rows += [(len(rows) + i, f"{lorem(rng, 30)} {passage} {lorem(rng, 25)}") for i in range(12)]
    rows += [(len(rows) + i, lorem(rng, rng.randint(1, 80))) for i in range(20)]
    rows.append((len(rows), lorem(rng, 9_000)))
    rows += [rows[40], rows[60], (None, rows[50][1]), (None, None)]
    return rows


def documents(spark, rows=None):
    rows = document_rows() if rows is None else rows
    return spark.createDataFrame([(i, t, *"abcdefg") for i, t in rows], DOCS).repartition(3)


def shingles(text: str | None) -> set[tuple[str, ...]]:
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def joined(ids, pairs) -> dict:
    """Smallest id reachable, by id."""
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def similar_components(rows) -> dict:
    sets = {}
    for i, text in rows:
        if i is not None:
            sets[i] = shingles(text)
    ids = sorted(sets)
    pairs = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if (both := len(sets[a] & sets[b])) and 100 * both >= 75 * len(sets[a] | sets[b])
    ]
    return joined(ids, pairs)


def repeated_bytes(texts: list[str | None], length: int) -> list[list[tuple[int, int]]]:
    """Maximal runs of bytes covered by a string of ``length`` bytes that starts at two places at least."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for r in raw:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    out = []
    for r in raw:
        runs: list[list[int]] = []
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        out.append([tuple(x) for x in runs])
    return out


def repeated_words(texts: list[str | None], n: int) -> list[list[tuple[int, int]]]:
    """Byte ranges of all runs of ``n`` words whose words start at two places at least."""
    found = [list(re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for t in texts]
    seen: dict[tuple, int] = {}
    for ms in found:
        for i in range(len(ms) - n + 1):
            run = tuple(m.group() for m in ms[i : i + n])
            seen[run] = seen.get(run, 0) + 1
    return [[(ms[i].start(), ms[i + n - 1].end()) for i in range(len(ms) - n + 1)
             if seen[tuple(m.group() for m in ms[i : i + n])] > 1] for ms in found]
