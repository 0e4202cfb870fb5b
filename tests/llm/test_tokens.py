"""Token counts, byte-level BPE and packing against the libraries."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from frames import ODD_TEXTS, document_rows, documents, lorem
from tokenizers import Tokenizer

from diamondlake.llm import text_units
from diamondlake.llm.level_packing import LevelPacker, Piece, UnitTokens, pack_documents
from diamondlake.llm.merge_replay import MergeReplay, encode_documents, round_trip
from diamondlake.llm.prefix_bpe import PrefixBpe, count_tokens

JSON, RANKS, WORDS = (P.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
TEXTS = [t or "" for _, t in document_rows()] + ["a  b \n c", " lead", "trail ", "don't 're 'l", "\r\n\r\n x", "ffff́ ́e"]


@pytest.fixture(scope="module")
def bpe():
    return PrefixBpe(JSON)


@pytest.fixture(scope="module")
def replay():
    return MergeReplay(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def rank_library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts(bpe):
    library = Tokenizer.from_file(JSON)
    assert bpe.counts(TEXTS) == [len(library.encode(t, add_special_tokens=False).ids) for t in TEXTS]


@pytest.mark.parametrize("text", [t[:260] for t in TEXTS if t][:30])
def test_every_prefix(bpe, text):
    library = Tokenizer.from_file(JSON)
    want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    table = bpe.table(text)
    assert table == want
    cut = bpe.longest_prefix(text, 5, table)
    assert max(want[: cut + 1]) <= 5 and (cut == len(text) or want[cut + 1] > 5)


def test_count_query(spark, bpe):
    rows = document_rows()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(documents(spark), JSON).collect())
    want = sorted((i is None, i or 0, len((t or "").encode()), n, n > 512) for (i, t), n in ((row, bpe.count(row[1] or "")) for row in rows))
    assert got == want


def test_replay(replay, rank_library):
    packed = replay.encode_packed(TEXTS)
    for text, ids in zip(TEXTS, packed):
        assert np.frombuffer(ids, dtype="<u4").tolist() == rank_library.encode_ordinary(text)
        assert replay.decode_packed(ids) == text.encode()


def test_replay_out_of_order():
    """Words in which a merge forms a pair of lower rank come out as in the greedy order."""
    coder = MergeReplay(RANKS, P.PATTERN)
    rng = random.Random(3)
    # Tokens of a small alphabet with shuffled ranks, so that parts often rank above the whole.
    letters = [bytes([b]) for b in b"abc"]
    longer = list({bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 4))) for _ in range(60)})
    rng.shuffle(longer)
    ranks = {t: i for i, t in enumerate(letters + longer)}
    coder.pairs = {
        ranks[t[:k]] << 32 | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
    }
    coder.byte_ids[list(b"abc")] = [0, 1, 2]
    coder.first[:] = -1
    for a in b"abc":
        for b in b"abc":
            coder.first[a, b] = coder.pairs.get(ranks[bytes([a])] << 32 | ranks[bytes([b])], -1)
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12))) for _ in range(500)]
    got = [np.frombuffer(p, dtype="<u4").tolist() for p in coder.replay(words)]
    assert got == [coder.greedy(w) for w in words] and coder.out_of_order


def test_round_trip_query(spark, rank_library):
    rows = document_rows()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in round_trip(documents(spark), RANKS, P.PATTERN).collect())
    want = []
    for i, t in rows:
        ids = rank_library.encode_ordinary(t or "")
        want.append((i is None, i or 0, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    one = encode_documents(documents(spark, [(1, "hello there")]), RANKS, P.PATTERN).first()
    assert one["ids"] == rank_library.encode_ordinary("hello there")


def test_units_and_cache(monkeypatch):
    for text in TEXTS:
        assert "".join(text_units.units_in_order(text)) == text
    cache = text_units.UnitCache(limit=2)
    for unit in "abcab":
        for new in cache.missing({unit}):
            cache.known[new] = new * 2
        assert cache.known[unit] == unit * 2
    assert len(cache.known) <= 3 and len(cache.old) <= 3


def test_word_ids():
    library, units = Tokenizer.from_file(WORDS), UnitTokens(WORDS)
    for text, packed in zip(TEXTS, units.packed(TEXTS)):
        assert np.frombuffer(packed, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_word_ids_of_odd_characters():
    """Characters whose case, class or composition differs between libraries, special strings, control characters."""
    rng, library, units = random.Random(4), Tokenizer.from_file(WORDS), UnitTokens(WORDS)
    marks = list("aB'sTlLmM eE \n\t\x85\xa0\x1c\x1f\x00\x7f\x9f½1²İȺßÉéǄǅʰ˥˿̀́-.ſK日😀") + ["<|endoftext|>", "<|ENDOFTEXT|>"]
    texts = ["", " ", *("".join(rng.choices(marks, k=rng.randint(0, 40))) for _ in range(3_000))]
    for at in range(0, len(texts), 500):
        for text, packed in zip(texts[at : at + 500], units.packed(texts[at : at + 500])):
            assert np.frombuffer(packed, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert units.packed([]) == [] and units.packed([""]) == [b""]


def test_pack_query(spark):
    rows = document_rows() + [(500, lorem(random.Random(5), 5_000))]
    library = Tokenizer.from_file(WORDS)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows if i is not None}
    pieces = pack_documents(documents(spark, rows), WORDS).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        if p["doc_id"] is not None:
            part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
            assert p["doc_tokens"] == len(ids[p["doc_id"]]) and len(part) == p["length"]
            assert p["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
    repeats = {i: sum(j == i for j, _ in rows) for i in ids}
    for i, own in ids.items():
        covered = sorted(x for p in by_doc[i] for x in range(p["start"], p["start"] + p["length"]))
        assert covered == sorted(x for x in range(len(own)) for _ in range(repeats[i]))
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        fill = 0
        for p in own:
            assert p["offset"] == fill
            fill += p["length"]
        assert fill <= 2048 and fill & (fill - 1) == 0  # nothing is padded


def test_level_choice():
    """The level taken is the one with the least sum of squared counts."""
    rng = random.Random(2)
    packer, window = LevelPacker(16), 16
    for _ in range(300):
        size = rng.randint(1, 15)
        before = {level: len(b) for level, b in packer.open.items() if b}

        def cost(level):
            after = dict(before)
            if level:
                after[level] -= 1
            if level + size < window:
                after[level + size] = after.get(level + size, 0) + 1
            return sum(n * n for n in after.values())

        best = min(cost(level) for level in [0, *before] if level + size <= window)
        packer.place(Piece(1, 0, b"\0" * 4 * size, size))
        assert sum(len(b) ** 2 for b in packer.open.values()) == best


def test_empty_tables(spark):
    none = documents(spark, [])
    assert count_tokens(none, JSON).count() == round_trip(none, RANKS, P.PATTERN).count() == pack_documents(none, WORDS).count() == 0
    assert ODD_TEXTS[0] is None
