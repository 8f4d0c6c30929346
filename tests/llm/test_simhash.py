"""Against all pairs."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from coursetide.llm import simhash
from coursetide.llm.components import components

from .data import awkward, documents, prose


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints):
    """Smallest id each row reaches, by trying all pairs."""
    values = np.array([p for _, p in prints], "u8")
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in np.flatnonzero(np.bitwise_count(values ^ values[a]) <= 2).tolist():
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(prints))]


def test_awkward_texts(spark):
    rows = awkward() + [(30 + k, prose(50, 200) + f" x{k}") for k in range(40)]
    prints = simhash.fingerprints(documents(spark, rows, clash=True))
    got = sorted((str(r.doc_id), r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(prints).collect())
    plain = [(i, plain_fingerprint(t)) for i, t in rows]
    want = zip(plain, plain_components(plain), strict=True)
    assert got == sorted((str(i), p, c) for (i, p), c in want)


@pytest.mark.parametrize("hot", [20, 1024])
def test_clustered_fingerprints(spark, monkeypatch, hot):
    """Many that share most bits, so that nodes are large; cut further or not."""
    monkeypatch.setattr(simhash, "HOT", hot)
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**63, 20, dtype="u8")
    found = set()
    for k in range(2500):
        x = int(base[k % 3 if k < 1800 else k % 20])
        for b in draw.integers(0, 64, draw.integers(0, 7)):
            x ^= 1 << int(b if draw.random() < 0.3 else b % 13)
        found.add(x)
    rows = list(enumerate(sorted(found)))
    table = spark.createDataFrame([(i, int(np.uint64(x).view("i8"))) for i, x in rows], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(table).collect()}
    assert [got[i] for i, _ in rows] == plain_components(rows)
    assert len(set(got.values())) > 20


def test_every_pair_in_the_radius_shares_a_mask():
    masks = simhash._masks(2)
    assert len(masks) == 9 and len(simhash._masks(3)) == 27
    for deep in (masks, simhash._masks(3)):
        for a in range(64):
            for b in range(64):
                assert any(not mask & (1 << a | 1 << b) for mask in deep)


def test_no_rows(spark):
    prints = simhash.fingerprints(documents(spark, []))
    assert simhash.near_duplicates(prints).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(60)]
    star = [(1000, k) for k in range(1001, 1300)]
    loops = [(5, 5), (7, None), (None, 7), (1, 0)]
    table = spark.createDataFrame(chain + star + loops, "a long, b long")
    got = {r.node: r.root for r in components(table).collect()}
    assert got == {k: 0 for k in range(1, 61)} | {k: 1000 for k in range(1001, 1300)}
    assert components(table.limit(0)).count() == 0
