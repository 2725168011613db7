"""SimHash against a direct version, links against all pairs."""

import random

import numpy as np
import xxhash
from cases import AWKWARD, components, documents, words

from driftwell.llm import simhash
from driftwell.llm.components import connected_components


def direct(text, size=3):
    w = [x for x in __import__("re").split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if x]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(spark):
    rng = random.Random(2)
    texts = [" ".join(words(rng, rng.randrange(1, 200))) for _ in range(60)]
    for t in texts[:30]:
        w = t.split()
        for _ in range(3):
            w = list(w)
            w[rng.randrange(len(w))] = "other"
            texts.append(" ".join(w).upper())
    texts += AWKWARD + [texts[0]] * 50
    ids = rng.sample(range(500), len(texts))
    ids[7] = None
    docs = documents(spark, texts, ids).repartition(4)
    found = {(r["doc_id"], r["fp"] % (1 << 64)): r for r in simhash.simhash_duplicates(docs).collect()}
    prints = [direct(t) for t in texts]
    assert set(found) == {(i, p) for i, p in zip(ids, prints)}
    distinct = sorted(set(prints))
    group = components(distinct, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, p in zip(ids, prints):
        if i is not None:
            least[group[p]] = min(least.get(group[p], i), i)
    assert {k: r["component_id"] for k, r in found.items()} == {(i, p): least.get(group[p]) for i, p in zip(ids, prints)}


def test_shards_find_every_pair(spark):
    """Small shards, dense neighbourhoods and ties in distance; components as from all pairs."""
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(25)]
    points = set(centres)
    for c in centres:
        x = c
        for _ in range(40):
            x ^= 1 << rng.randrange(64)
            points |= {x, c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))}
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(6)
    edges = simhash.near_edges(frame, shard_rows=20, sample=200)
    expected = components(points, lambda a, b: (a ^ b).bit_count() <= 2)
    rows = connected_components(edges).collect()
    got = {r["node"] % (1 << 64): r["component"] % (1 << 64) for r in rows}
    blocks = lambda least: {frozenset(p for p in points if least.get(p, p) == v) for v in set(least.get(p, p) for p in points)}
    assert blocks(got) == blocks(expected)


def test_a_branch_is_left_out_only_by_the_triangle_bound():
    rng = np.random.default_rng(3)
    rows = np.unique(rng.integers(0, 1 << 64, 600, dtype=np.uint64))
    rows = np.unique(np.concatenate([rows, rows ^ np.uint64(3)]))
    tree = simhash.VantageTree.fit(rows[::3], 12)
    homes, asked = {}, {}
    for shard, index, home in tree.route(rows, 2):
        for i, h in zip(index.tolist(), home.tolist()):
            asked.setdefault(i, set()).add(shard)
            if h:
                assert i not in homes
                homes[i] = shard
    assert len(homes) == len(rows)
    near = simhash.distances(rows[:, None], rows[None, :]) <= 2
    assert all(homes[j] in asked[i] for i, j in zip(*np.nonzero(near)))


def test_empty_and_null(spark):
    assert simhash.simhash_duplicates(documents(spark, [])).count() == 0
    only_null = documents(spark, [None, ""], [None, None])
    assert {(r["fp"], r["component_id"]) for r in simhash.simhash_duplicates(only_null).collect()} == {(0, None)}
    assert simhash.simhash("word " * 50_000) == simhash.simhash("word word word")


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(5, 5), (200, 199), (200, 199)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 180)}, 199: 199, 200: 199}
    assert connected_components(frame.where("a < 0")).count() == 0
