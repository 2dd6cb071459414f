import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sluice.llm import queries, runs


def brute(words):
    """All runs by comparing the text with itself at every distance."""
    out, n = set(), len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(24, 3 * q) and not any(
                q % p == 0 and words[start : end - p] == words[start + p : end] for p in range(1, q)
            ):
                out.add((start, end - start, q))
            i += 1
    return sorted(out)


def odd_texts(count, seed):
    rng = random.Random(seed)
    texts = []
    for k in range(count):
        letters, words = rng.choice([1, 2, 3, 50]), []
        for _ in range(rng.randrange(1, 6)):
            words += [str(rng.randrange(letters)) for _ in range(rng.randrange(40))]
            base = [str(rng.randrange(letters + 1)) for _ in range(rng.randrange(1, rng.choice([4, 20, 90])))]
            words += [base[i % len(base)] for i in range(rng.randrange(1, 5 * len(base) + 30))]
        texts += [" ".join(words)] * (1 + (k % 20 == 0))
    return texts


def test_runs_match_brute_force():
    texts = odd_texts(300, 5)
    _, found, collapsed = runs.runs_of(texts)
    for text, have, short in zip(texts, found, collapsed):
        words = text.split()
        want = brute(words)
        assert want == list(map(tuple, have.tolist())), text
        gone = {i for s, length, q in want for i in range(s + q, s + length)}
        assert short == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert sum(map(len, found)) > 300


def test_shortest_runs_at_every_place_and_period():
    for q in [*range(1, 20), 31, 32, 33, 63, 64, 65, 130]:
        for ahead in range(0, 2 * q + 10, max(1, q // 5)):
            length = max(24, 3 * q)
            words = [f"a{i}" for i in range(ahead)] + [f"b{i % q}" for i in range(length)] + ["end"]
            _, found, _ = runs.runs_of([" ".join(words)])
            assert found[0].tolist() == [[ahead, length, q]], (q, ahead)
            short = words[:ahead] + words[ahead + 1 :]
            assert not len(runs.runs_of([" ".join(short)])[1][0])


@pytest.mark.parametrize("name, value", [("_MIX", 0), ("_BASE", 0), ("LEVELS", 1)])
def test_misleading_numbers_change_nothing(monkeypatch, name, value):
    texts = odd_texts(40, 6)
    want = [brute(t.split()) for t in texts]
    monkeypatch.setattr(runs, name, np.uint64(value) if name != "LEVELS" else value)
    assert [list(map(tuple, f.tolist())) for f in runs.runs_of(texts)[1]] == want


def test_convolution_is_exact():
    rng = np.random.default_rng(1)
    values = rng.integers(0, runs.LEVELS, 2000).astype(float)
    values[[3, 500]] = [0, runs.LEVELS - 1]
    for size in (8, 16, 32):
        conv = runs.Convolver(values, size)
        a = rng.integers(0, conv.rows - 2, 300)
        c = rng.integers(0, conv.rows - 2, 300)
        c[:50] = a[:50]
        got = set(zip(*map(np.ndarray.tolist, conv.matches(a, c))))
        want = set()
        for i, j in zip(a.tolist(), c.tolist()):
            block = values[i * size : (i + 1) * size]
            want |= {(i * size, j * size + o) for o in range(size) if (values[j * size + o : j * size + o + size] == block).all()}
        assert got == want


def test_long_texts():
    for words, want in (
        (["a"] * 100_000, [[0, 100_000, 1]]),
        ((["a"] * 50 + ["b"]) * 1000, [[51 * i, 50, 1] for i in range(1000)] + [[0, 51_000, 51]]),
        ([f"w{i % 30_011}" for i in range(100_000)], [[0, 100_000, 30_011]]),
    ):
        assert runs.runs_of([" ".join(words)])[1][0].tolist() == sorted(want, key=lambda r: (r[0], r[2]))


def periodic_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = periodic_words(doc_id, text)
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        digest("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_against_brute_force(spark, tmp_path, texts):
    rows = [(i, t) for i, t in texts if len(t or "") < 20_000]
    rng = random.Random(3)
    rows += [(i, " ".join(str(rng.randrange(9)) for _ in range(rng.randrange(300)))) for i in range(100, 300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.QUERIES["op11_block_convolution_runs"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 10


def test_edge_rows(docs, texts, nothing):
    found = runs.periodic_runs(docs, "text", "doc_id").collect()
    assert len(found) == len(texts)
    by = {r.doc_id: r for r in found}
    assert by[4].runs == by[5].runs == by[6].runs == [] and by[4].collapsed == by[6].collapsed == ""
    assert by[9].runs and by[9].n_words == 30_000
    assert runs.periodic_runs(nothing, "text", "doc_id").count() == 0
