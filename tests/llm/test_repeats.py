"""Suffix and substring deduplication against brute force on every window."""

import hashlib
import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from cases import AWKWARD, documents, words

from driftwell.llm import recompression, suffixes
from driftwell.llm.repeats import APART, LOOSE, SETTLED, TELLS, Ranges, mix, settle_stretches


def brute_bytes(rows, window=50):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        key = float("inf") if i is None else i
        for s in range(len(raw) - window + 1):
            first[raw[s : s + window]] = min(first.get(raw[s : s + window], key), key)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        key = float("inf") if i is None else i
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for s in range(len(raw) - window + 1):
            if first[raw[s : s + window]] < key:
                gone[s : s + window] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(bool(g and not (k and gone[k - 1])) for k, g in enumerate(gone))
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_words(rows, window=35):
    seen = defaultdict(int)
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for _, w in split:
        for s in range(len(w) - window + 1):
            seen[tuple(w[s : s + window])] += 1
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, vocabulary):
    """Texts with shared stretches of many lengths, long runs, copies and periods."""
    rng = random.Random(seed)
    texts = [" ".join(words(rng, rng.randrange(1, 250), vocabulary)) for _ in range(40)]
    for _ in range(60):
        source = rng.choice(texts).split()
        a = rng.randrange(len(source))
        piece = source[a : a + rng.randrange(1, 120)]
        text = [*words(rng, rng.randrange(60), vocabulary), *piece, *words(rng, rng.randrange(60), vocabulary), *piece[: rng.randrange(50)]]
        texts.append(rng.choice([" ", "\n", "  "]).join(text))
    texts += [texts[3], texts[3], "ha " * 500, "ha " * 90, "ab" * 200, "a" * 400, "a" * 49, "x" * 50, "x" * 50, "ab cd " * 60]
    return texts + AWKWARD


@pytest.mark.parametrize(("seed", "vocabulary"), [(1, 300), (2, 12), (3, 3)])
def test_bytes_and_words_agree_with_brute_force(spark, seed, vocabulary):
    texts = corpus(seed, vocabulary)
    rng = random.Random(seed)
    ids = rng.sample(range(1000), len(texts))
    ids[5] = ids[6] = None
    ids[8] = ids[9]
    docs = documents(spark, texts, ids).repartition(5)
    rows = list(zip(ids, texts))
    found = suffixes.remove_repeated_bytes(docs).drop("kept")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_bytes(rows)
    found = recompression.remove_repeated_words(docs).drop("kept")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_words(rows)


@pytest.mark.parametrize("shared", [None, 7])
def test_texts_of_one_id_are_never_mixed_up(spark, shared):
    rng = random.Random(21)
    passage = words(rng, 60)
    long = " ".join([*words(rng, 200), *passage])
    low = lambda t: xxhash.xxh64_intdigest(t, 42) & ((1 << 20) - 1)
    # A short text whose hash has the lower 20 bits of the long one's.
    short = next(t for t in (f"clean words of a text {i} that is short" for i in itertools.count()) if low(t) == low(long))
    texts, ids = [" ".join(passage), long, short], [1, shared, shared]
    docs, rows = documents(spark, texts, ids).repartition(3), list(zip(ids, texts))
    found = suffixes.remove_repeated_bytes(docs).drop("kept")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_bytes(rows)
    found = recompression.remove_repeated_words(docs).drop("kept")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_words(rows)
    kept = recompression.without_repeated_words(docs, size_col="n_chars")
    assert short in {r["text"] for r in kept.collect()}


def test_many_copies_and_one_passage(spark):
    rng = random.Random(9)
    passage = words(rng, 60)
    texts = [" ".join([*words(rng, 20), *passage, *words(rng, 20)]) for _ in range(300)]
    texts += [" ".join(passage)] * 200
    docs = documents(spark, texts).repartition(7)
    rows = list(enumerate(texts))
    assert sorted((tuple(r) for r in suffixes.remove_repeated_bytes(docs).drop("kept").collect()), key=str) == brute_bytes(rows)
    assert sorted((tuple(r) for r in recompression.remove_repeated_words(docs).drop("kept").collect()), key=str) == brute_words(rows)


@pytest.mark.parametrize("crowd", [1, 8])
def test_crowded_keys_give_the_same_rows(spark, crowd):
    """A passage among other words each time, and texts of few words, whichever way their windows go."""
    rng = random.Random(11)
    passage = words(rng, 60)
    texts = [" ".join([*words(rng, 15, 40), *passage[rng.randrange(3) :], *words(rng, 15, 40)]) for _ in range(200)]
    texts += corpus(2, 12) + corpus(3, 3)
    ids = rng.sample(range(2000), len(texts))
    ids[5] = ids[6] = None
    ids[8] = ids[9]
    docs = documents(spark, texts, ids).repartition(4)
    rows = list(zip(ids, texts))
    found = suffixes.remove_repeated_bytes(docs, crowd=crowd).drop("kept")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_bytes(rows)
    found = recompression.remove_repeated_words(docs, crowd=crowd).drop("kept")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_words(rows)


def test_a_crowded_key_sends_two_stretches_to_its_target():
    """Tuples that all share a key spread over the targets, but for two of them."""
    scheme = recompression.SharedSymbols(crowd=4)
    rng = random.Random(12)
    middle = [f"m{i}" for i in range(40)]
    texts = [" ".join([*words(rng, 30), *middle, *words(rng, 30)]).encode() for _ in range(50)]
    units = [scheme.units(t) for t in texts]
    places = [scheme.anchors(u, np.array([0]), np.array([len(u)]))[0] for u in units]
    keys = [scheme.keys(u, p) for u, p in zip(units, places)]
    shared = set.intersection(*(set(k.tolist()) for k in keys))
    assert shared
    key = np.full(50, next(iter(shared)), dtype=np.uint64)
    state = settle_stretches(scheme, key, np.arange(50, dtype=np.uint64), np.arange(50))
    assert sorted(state.tolist()) == [TELLS] * 2 + [APART] * 48
    # Equal stretches stay with their key.
    state = settle_stretches(scheme, key, np.zeros(50, dtype=np.uint64), np.arange(50))
    assert sorted(state.tolist()) == [LOOSE] * 2 + [SETTLED] * 48


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(60))
    twice = documents(spark, [text, text], [4, 4])
    assert [r["n_removed"] for r in suffixes.remove_repeated_bytes(twice).collect()] == [0, 0]
    assert [r["n_removed"] for r in recompression.remove_repeated_words(twice).collect()] == [60, 60]
    nothing = documents(spark, [])
    assert suffixes.remove_repeated_bytes(nothing).count() == 0
    assert recompression.remove_repeated_words(nothing).count() == 0
    assert recompression.without_repeated_words(nothing).count() == 0


def test_cleaned_documents_keep_their_columns(spark):
    shared = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [f"a b\n{shared}", f"{shared} c", "left\nas it is", None])
    cleaned = recompression.without_repeated_words(docs, size_col="n_chars")
    assert cleaned.schema == docs.schema
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in cleaned.collect()} == {0: ("a b", 3), 1: ("c", 1), 2: ("left\nas it is", 13), 3: (None, None)}


def test_anchor_depends_on_its_window_only():
    """Equal windows have anchors at equal offsets, whatever stands around them."""
    rng = random.Random(5)
    for scheme in (recompression.SharedSymbols(), suffixes.SampledSuffixes()):
        for _ in range(200):
            middle = " ".join(words(rng, 120, 4)).encode()
            offsets = []
            for _ in range(2):
                before = " ".join(words(rng, rng.randrange(1, 40), 4)).encode() + b" "
                units = scheme.units(before + middle + b" " + " ".join(words(rng, rng.randrange(1, 40), 4)).encode())
                shift = len(scheme.units(before))
                size = len(scheme.units(middle))
                places, low, high = scheme.anchors(units, np.array([0]), np.array([len(units)]))
                at = {}
                for p, a, b in zip(places.tolist(), low.tolist(), high.tolist()):
                    at |= {p - d: d for d in range(a, b + 1)}
                assert sorted(at) == list(range(len(units) - scheme.window + 1))
                assert all(scheme.least <= d <= scheme.most for d in at.values())
                offsets.append([at[shift + s] for s in range(size - scheme.window + 1)])
            assert offsets[0] == offsets[1]


def test_symbols_of_several_texts_are_those_of_each():
    rng = random.Random(6)
    scheme = recompression.SharedSymbols()
    texts = [scheme.units(" ".join(words(rng, rng.randrange(0, 90), 5)).encode()) for _ in range(30)]
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    places, low, high = scheme.anchors(np.concatenate(texts), begins, ends)
    alone = []
    for begin, units in zip(begins, texts):
        p, a, b = scheme.anchors(units, np.array([0]), np.array([len(units)]))
        alone += list(zip((p + begin).tolist(), a.tolist(), b.tolist()))
    assert list(zip(places.tolist(), low.tolist(), high.tolist())) == alone


def test_range_hashes_do_not_depend_on_the_place():
    units = np.frombuffer(b"abcabcabcabc" * 5, dtype=np.uint8)
    found = Ranges(units, 0).of(np.array([0, 3, 6, 1]), np.array([9, 12, 15, 10]))
    assert found[0] == found[1] == found[2] != found[3]
    assert len(set(mix(np.arange(1000, dtype=np.uint64)[:, None], 1).tolist())) == 1000


def test_long_texts_in_blocks(monkeypatch):
    rng = random.Random(7)
    scheme = suffixes.SampledSuffixes()
    units = scheme.units(" ".join(words(rng, 3000, 9)).encode())
    whole = scheme.anchors(units, np.array([0]), np.array([len(units)]))
    monkeypatch.setattr(suffixes, "_BLOCK", 100)
    parts = scheme.anchors(units, np.array([0]), np.array([len(units)]))
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_short_chance_meetings_end_in_the_first_round():
    """Texts that share 28 bytes meet by no key of the first round; those that share a window always do."""
    rng = np.random.default_rng(4)
    scheme = suffixes.SampledSuffixes()

    def keys(text):
        places, low, high = scheme.anchors(text, np.array([0]), np.array([len(text)]))
        number, found = scheme.parts(text, places, low, high)
        assert set(number.tolist()) == set(range(len(places)))
        return set(found.tolist()), set(scheme.keys(text, places).tolist())

    met = 0
    for _ in range(60):
        one, two = rng.integers(97, 123, (2, 300), dtype=np.uint8)
        two[100:128] = one[150:178]
        (a, whole_a), (b, whole_b) = keys(one), keys(two)
        assert not a & b
        met += bool(whole_a & whole_b)
        two[100:150] = one[150:200]
        assert keys(two)[0] & a
    assert met > 5
