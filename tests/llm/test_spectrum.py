import numpy as np
import pytest

from sluice.llm import queries, spectrum
from sluice.llm.spectrum import Spectrum


def numbers(kind, rows=300, width=12, seed=0):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(rows, width)) * np.exp(2 * rng.normal(size=width)) * 300).astype(np.int64) + 100_000
    if kind == "flat":
        x[:, 3] = 100_000
        x[:, 5] = x[:, 6]
    if kind == "few":
        x = np.repeat(x[:5], rows // 5, axis=0)
    if kind == "same":
        x[20:] = x[0]
    if kind == "ties":
        x = 100_000 + 512 * np.concatenate([np.eye(width, dtype=np.int64), -np.eye(width, dtype=np.int64)] * 4)
    return x


@pytest.mark.parametrize("kind", ["plain", "flat", "few", "same", "ties"])
def test_updates_and_merges_match_a_full_decomposition(kind):
    x = numbers(kind)
    parts = []
    for part in np.array_split(x, 3):
        own = Spectrum.empty(x.shape[1])
        for row in part:
            own.add(row)
        parts.append(own)
    whole = parts[0].merge(parts[1]).merge(parts[2])
    away = x - x.mean(axis=0)
    scatter = away.T @ away
    top = np.linalg.eigvalsh(scatter).max()
    assert (whole.n, whole.sums.tolist()) == (len(x), x.sum(axis=0).tolist())
    assert np.abs(whole.values - np.linalg.eigvalsh(scatter)).max() < 1e-12 * top
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - scatter).max() < 1e-12 * top


def test_secular_roots():
    rng = np.random.default_rng(3)
    for k in (1, 2, 5, 40):
        d, w = np.sort(rng.exponential(size=k)) * 100, rng.exponential(size=k) ** 6
        got = d - spectrum.secular_roots(d, w).diagonal()
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(w), np.sqrt(w)))
        assert np.allclose(got, want, rtol=1e-10, atol=1e-10)


def vectors(rng, rows, width=16):
    return (rng.normal(size=(rows, width)) * np.linspace(2, 0.1, width) + rng.normal(size=width)).astype(np.float32)


def test_query_against_a_full_decomposition(spark, tmp_path):
    found = vectors(np.random.default_rng(4), 500)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(found)] + [(3, found[3].tolist(), 2), (None, found[4].tolist(), 2)]
    good = [(i, v) for i, v, _ in rows]
    bad = found[0].tolist()
    rows += [(900, None, 1), (901, [None, *bad[1:]], 1), (902, [float("nan"), *bad[1:]], 1), (903, [float("inf"), *bad[1:]], 1), (904, [], 1)]
    rows += [(905, bad[:-1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int").repartition(5)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["op13_incremental_whitening"](spark, str(tmp_path)).collect()
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in good], dtype=np.int64)
    n, sums = len(x), x.sum(axis=0)
    away = x - sums / n
    values, turn = np.linalg.eigh(away.T @ away / n)
    values, turn = values[::-1][:8], turn[:, ::-1][:, :8]
    want = away @ turn / np.sqrt(values)
    share = values / (away * away).sum() * n
    assert len(got) == 8 * n and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-10
    exact = {i: int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))) for (i, _), row in zip(good, x)}
    by = {}
    for r in got:
        assert r.deviation == exact[r.vec_id]
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
        by.setdefault(r.vec_id, {})[r.component] = r.whitened
    have = np.array([[by[i][c] for c in range(1, 9)] for i, _ in good])
    signs = np.sign((have * want).sum(axis=0))
    assert np.abs(have * signs - want).max() < 1e-8


def test_far_tree_and_edge_tables(spark, monkeypatch):
    monkeypatch.setattr(spectrum, "FAN_IN", 2)
    found = vectors(np.random.default_rng(5), 60, 6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(found)], "vec_id long, embedding array<float>")
    got = spectrum.whiten(df.repartition(9), "embedding", "vec_id", 3)
    assert got.count() == 180 and got.head()["identity_error"] < 1e-10
    assert spectrum.whiten(df.limit(0), "embedding", "vec_id").count() == 0
    assert spectrum.whiten(df.limit(1), "embedding", "vec_id").count() == 0
    same = spark.createDataFrame([(i, [1.5, 2.0]) for i in range(9)], "vec_id long, embedding array<float>")
    assert spectrum.whiten(same, "embedding", "vec_id").count() == 0


def test_deviations_beyond_machine_words():
    x = np.array([[100_000, 163_840], [99_000, 100_001]], dtype=np.int64)
    for n in (3, 10**10):
        sums = np.array([100_003 * n + 1, 120_000 * n + 2], dtype=np.int64)
        want = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
        assert spectrum.deviations(x, n, sums) == want
