import re

import numpy as np
import pytest
import xxhash

from sluice.llm import simhash
from sluice.llm.components import components


def roots(values, most):
    """Union-find over all pairs."""
    up = list(range(len(values)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= most) + i + 1:
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def brute_print(text):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("most", [1, 2, 3])
def test_families_of_near_fingerprints(spark, most):
    rng = np.random.default_rng(most)
    centres = rng.integers(0, 1 << 64, 12, dtype=np.uint64)
    values = set()
    for _ in range(1500):
        flips = rng.integers(0, 64, rng.integers(0, 6))
        values.add(int(centres[rng.integers(12)]) ^ sum({1 << int(f) for f in flips}))
    values = np.array(sorted(values), dtype=np.uint64)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    edges = simhash.links(df, most)
    got = {r.node: r.root for r in components(edges).collect()}
    names = values.view(np.int64)
    want = roots(values, most)
    groups = {}
    for v, r in zip(names.tolist(), want):
        groups.setdefault(r, set()).add(v)
    mine = {}
    for v in names.tolist():
        mine.setdefault(got.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_documents(docs, texts, nothing):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, "text", "doc_id").collect()}
    values = np.array([brute_print(t) for _, t in texts], dtype=np.uint64)
    want = roots(values, 2)
    low = {r: min((i for (i, _), w in zip(texts, want) if w == r and i is not None), default=None) for r in want}
    assert got == {(i, f"{int(v):016x}", low[r]) for (i, _), v, r in zip(texts, values, want)}
    assert simhash.near_duplicates(nothing, "text", "doc_id").count() == 0


def test_components_of_chains(spark):
    rng = np.random.default_rng(4)
    names = rng.permutation(400).tolist()
    edges = [(names[i], names[i + 1]) for i in range(399) if i % 100 != 99] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for start in range(0, 400, 100):
        chain = names[start : start + 100]
        assert {got[n] for n in chain} == {min(chain)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
