import random

import pytest
from pyspark.sql import functions as F

from sluice.llm import repeats


def brute(rows, size=50):
    low = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        for p in range(len(t) - size + 1):
            low.setdefault(t[p : p + size], i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - size + 1):
            first = low[t[p : p + size]]
            if first is not None and (i is None or first < i):
                gone[p : p + size] = b"\1" * size
        out.append((i, len(t), bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(map(str, out))


def result(df):
    return sorted(str((r.doc_id, r.n_bytes, bytes(r.kept))) for r in df.select("doc_id", "n_bytes", "kept").collect())


@pytest.mark.parametrize("chunk", [2_000, 8_000_000])
def test_matches_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(repeats, "SUFFIXES", 500)
    rng = random.Random(chunk)
    parts = ["".join(rng.choice("abc dé") for _ in range(rng.choice([20, 49, 50, 51, 80, 200]))) for _ in range(25)]
    parts += ["-" * 70, "ab" * 60, "x" * 30]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(7)))) for i in range(150)]
    rows += [(3, rows[3][1]), (None, rows[5][1]), (None, rows[5][1]), (200, None), (201, "é" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.remove_repeats(df, "text", "doc_id")
    assert result(got) == brute([(i, (t or "").encode()) for i, t in rows])
    for r in got.collect():
        covered = sum(s.length for s in r.removed)
        assert covered == r.n_bytes - len(r.kept)
        assert all(a.start + a.length < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_edge_rows(docs, texts, nothing):
    docs, nothing = (d.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("removed", "n_bytes", "bucket"))]) for d in (docs, nothing))
    got = repeats.remove_repeats(docs, "text", "doc_id")
    assert got.columns == [*(c for c in docs.columns if c not in repeats.ADDED), *repeats.ADDED]
    want = brute([(i, (t or "").encode()) for i, t in texts])
    assert result(got) == want
    apart = repeats.remove_repeats(docs, "text", "doc_id", added=("a", "b", "c"))
    assert apart.columns == [*docs.columns, "a", "b", "c"] and {r.kept for r in apart.collect()} == {docs.first()["kept"]}
    assert sorted(str((r.doc_id, r.a, bytes(r.c))) for r in apart.collect()) == want
    assert repeats.remove_repeats(nothing, "text", "doc_id").count() == 0


def test_hot_anchor_is_spread(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 20_000)
    rng, common = random.Random(9), "the head that every page has, with a name: "
    rows = [(i, "".join(rng.choice("abcdef") for _ in range(30)) + common + "".join(rng.choice("abcdef") for _ in range(30))) for i in range(400)]
    rows += [(1000 + i, rows[i][1][rng.randrange(20):]) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute([(i, t.encode()) for i, t in rows])
    for hot in (10, 100_000):
        monkeypatch.setattr(repeats, "HOT_CONTEXTS", hot)
        assert result(repeats.remove_repeats(df, "text", "doc_id")) == want
    # Under a limit of 10 no key is left with more than the windows that are equal.
    data = "\n".join(t for _, t in rows).encode()
    chunk = repeats.Chunk.__new__(repeats.Chunk)
    chunk.size, chunk.bits, chunk.text, chunk.ends = 50, 6, data, repeats.np.array([len(data)])
    key, chunk.first, chunk.count = repeats.contexts(repeats.np.frombuffer(data, "u1"), chunk.ends, 50)
    chunk.doc = repeats.np.arange(len(chunk.first))
    chunk.keys, chunk.of_key = repeats.np.unique(key, return_inverse=True)
    chunk.shared({b: repeats.packed(repeats.np.full(s.stop - s.start, 2, "u1")) for b, s in chunk.buckets(chunk.keys)})
    assert len(repeats.np.unique(chunk.text_keys)) == len(chunk.texts) == len({data[i : i + 50] for i in range(len(data) - 49)})


def test_slice_hashes():
    data = repeats.np.frombuffer(bytes(random.Random(2).choice(b"ab") for _ in range(3000)) * 800, "u1")
    rng = random.Random(3)
    first = repeats.np.array(sorted(rng.randrange(len(data) - 100) for _ in range(5000)))
    length = repeats.np.array([rng.randrange(1, 90) for _ in first])
    names = {}
    for h, a, n in zip(repeats.slice_hashes(data, first, length).tolist(), first.tolist(), length.tolist()):
        assert names.setdefault(h, data[a : a + n].tobytes()) == data[a : a + n].tobytes()
    assert len(names) == len({data[a : a + n].tobytes() for a, n in zip(first.tolist(), length.tolist())})


def test_characters_stay_whole(spark):
    shared = "é" * 40
    df = spark.createDataFrame([(1, "a" + shared), (2, "ü" + shared[1:] + "b")], "doc_id long, text string")
    kept = {r.doc_id: r.t for r in repeats.remove_repeats(df, "text", "doc_id", whole_chars=True)
            .select("doc_id", F.decode("kept", "UTF-8").alias("t")).collect()}
    assert kept == {1: "a" + shared, 2: "übu"[:1] + "b"}


def test_maximal_repeats_have_all_occurrences():
    rng = random.Random(6)
    core = bytes(rng.choice(b"acgt") for _ in range(60))
    texts = [b"1" + core + b"x", b"2" + core + b"x", b"3" + core[:55] + b"yyyyy"]
    counts = [len(t) - 49 for t in texts]
    suffixes, found = repeats.maximal_repeats(texts, repeats.np.array(counts), 50)
    got = {(length, tuple(sorted(map(tuple, suffixes[a : b + 1].tolist())))) for a, b, length in found}
    assert got == {(61, ((0, 1), (1, 1))), (55, ((0, 1), (1, 1), (2, 1)))}


def test_rows_between_chunks_and_buckets_grow_with_the_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 20_000)
    rows = {}
    for many in (300, 1200):
        df = spark.range(many).selectExpr("id as doc_id", "array_join(transform(sequence(1, 40), i -> md5(concat(id, '-', i))), '') as text").repartition(1)
        kept = []
        monkeypatch.setattr(repeats, "durable", lambda d, own=repeats.durable: kept.append(own(d)) or kept[-1])
        repeats.remove_repeats(df, "text", "doc_id")
        monkeypatch.undo()
        monkeypatch.setattr(repeats, "CHUNK_BYTES", 20_000)
        chunks, flags = kept[0].count(), kept[1].groupBy("chunk").count().agg(F.max("count")).first()[0]
        rows[many] = (chunks, flags)
        assert chunks > 15 and flags <= 2 * chunks
    assert rows[1200][0] > 3 * rows[300][0]


def test_contexts_by_blocks(monkeypatch):
    rng = random.Random(5)
    for block in (7, 64, 1 << 14):
        monkeypatch.setattr(repeats, "BLOCK", block)
        texts = [bytes(rng.choice(b"abc de") for _ in range(rng.choice([0, 0, 1, 20, 49, 50, 51, 90, 400]))) for _ in range(60)]
        data, ends = repeats.np.frombuffer(b"".join(texts), "u1"), repeats.np.cumsum([len(t) for t in texts])
        key, first, count = repeats.contexts(data, ends, 50)
        starts = ends - [len(t) for t in texts]
        inside = [p for a, b in zip(starts.tolist(), ends.tolist()) for p in range(a, b - 49)]
        assert [p for f, n in zip(first.tolist(), count.tolist()) for p in range(f, f + n)] == inside
        # Equal windows name equal anchors.
        named = {}
        for k, f, n in zip(key.tolist(), first.tolist(), count.tolist()):
            for p in range(f, f + n):
                assert named.setdefault(data[p : p + 50].tobytes(), k) == k
